"""Entities kept current by increments that read and write only what they touch.

Five keyed tables, each in hash buckets (`kinfold.sources.keyed`):

| table    | key                   | holds |
|----------|-----------------------|-------|
| members  | record_uid            | the root of the record's entity |
| entities | root_uid, record_uid  | the record's attributes, no payload and no log |
| evidence | group                 | the one entity whose records have this key evidence |
| slots    | slot, record_uid      | where a record can meet others for a fuzzy decision (if any pair can reach one) |
| winners  | root_uid              | per attribute the winning candidate with its sort keys |

Records with the same key evidence are always of one entity, so `evidence` needs
one row per value, however many records share it.

An increment has new or changed records and removed ones.

* Decremental part: the entities of changed and removed records are reopened, and
  formed anew from the evidence of the records they still have.  Nothing else can
  fall apart.
* Incremental part: the evidence of new and changed records is looked up.  An
  entity found there takes part as one vertex, its root; its records are not read
  unless its root changes.
* Survivorship: winners are minima of structs, so entities that meet combine theirs,
  and new records are further candidates.  A retraction matters where a changed or
  removed record was a winner, or an entity fell apart: only then are the remaining
  records' attributes read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.operators import linkage, survivorship
from kinfold.operators.components import connected_components
from kinfold.session import materialize
from kinfold.sources.keyed import STAMP, KeyedTable
from kinfold.spec import KEY, UPDATED, EntitySpec

CARRIED = ["source_id", KEY, "batch_id", "trust_rank", UPDATED]


@dataclass(frozen=True)
class Increment:
    """What a batch changed: entities formed anew or grown, and roots that no longer name an entity."""

    assigned: DataFrame   # record_uid, root_uid: new and changed records, and those whose entity has another root now
    touched: DataFrame    # root_uid: entities that hold or held a new, changed or removed record
    retired: DataFrame    # root_uid
    decisions: DataFrame  # match decisions that concern a touched entity (links) or a new or changed record (fuzzy)


class EntityStore:
    def __init__(self, spark: SparkSession, root: str, spec: EntitySpec):
        self.spark, self.spec, self.matching = spark, spec, spec.matching
        self.members, self.entities, self.evidence, self.slots, self.winners = (
            KeyedTable(spark, f"{root.rstrip('/')}/{name}") for name in ("members", "entities", "evidence", "slots", "winners"))
        self.columns = [*CARRIED, *spec.attributes]
        # A slot for the review threshold also holds for the higher automatic one.
        self.is_fuzzy = linkage.reachable_evidence(spec.matching, spec.matching.review) is not None
        self.merges_fuzzy = linkage.reachable_evidence(spec.matching, spec.matching.auto_match) is not None

    # ------------------------------------------------------------ whole tables

    def is_started(self) -> bool:
        return self.members.exists()

    def start(self, records: DataFrame, clusters: DataFrame, batch_id: str, as_of: str) -> None:
        """Begin with matched records: `clusters` has record_uid, root_uid."""
        rooted = materialize(self._narrow(records).join(clusters.select("record_uid", "root_uid"), "record_uid"), "rooted")
        self.members.start(rooted.select("record_uid", "root_uid"), ["record_uid"], ["record_uid"], batch_id)
        self.entities.start(rooted, ["root_uid", "record_uid"], ["root_uid"], batch_id)
        self.evidence.start(self._evidence(rooted), ["group"], ["group"], batch_id)
        self.winners.start(self._winners(rooted).withColumn("made_on", F.lit(as_of)), ["root_uid"], ["root_uid"], batch_id)
        if self.is_fuzzy:
            self.slots.start(self._slots(rooted), ["slot", "record_uid"], ["slot"], batch_id)

    def maintain(self, batch_id: str) -> None:
        for table in (self.members, self.entities, self.evidence, self.winners, *([self.slots] if self.is_fuzzy else [])):
            table.maintain(batch_id)

    def clusters(self, id_length: int = 32, upto: str | None = None) -> DataFrame:
        return linkage.label(self.members.read(upto=upto), id_length)

    def named_winners(self, id_length: int = 32, upto: str | None = None, roots: DataFrame | None = None) -> DataFrame:
        """Winner rows under their cluster_id, all or those of some roots, with `made_on` and the batch that made them."""
        rows = self.winners.read(upto=upto, among=roots, stamped=True).withColumnRenamed(STAMP, "batch_id")
        return self._named(rows, id_length, roots)

    def crosswalk(self, id_length: int = 32, upto: str | None = None, roots: DataFrame | None = None) -> DataFrame:
        rows = self.entities.read(upto=upto, among=roots, only=["source_id", KEY, "batch_id"])
        return survivorship.crosswalk(self._named(rows, id_length, roots))

    def entity_count(self, upto: str | None = None) -> DataFrame:
        """`record_pairs`: the number of entities, from the keys of their winners alone."""
        return self.winners.read(upto=upto, only=[]).agg(F.count("*").alias("record_pairs"))

    def golden(self, id_length: int = 32, upto: str | None = None, roots: DataFrame | None = None) -> DataFrame:
        """Golden records, each with the batch and date that made it."""
        return self.golden_of(self.named_winners(id_length, upto, roots))

    def golden_of(self, named: DataFrame) -> DataFrame:
        return named.select(
            F.col("cluster_id").alias("golden_id"), *[F.col(f"{a}.value").alias(a) for a in self.spec.attributes],
            F.col("made_on").cast("timestamp").alias("mdm_created_ts"), "batch_id")

    @staticmethod
    def _named(rows: DataFrame, id_length: int, roots: DataFrame | None) -> DataFrame:
        if roots is not None:
            rows = rows.join(roots.select("root_uid").distinct(), "root_uid", "left_semi")
        return rows.withColumn("cluster_id", linkage.cluster_name(F.col("root_uid"), id_length))

    # ------------------------------------------------------------ rows from records

    def _narrow(self, records: DataFrame) -> DataFrame:
        return records.select("record_uid", *self.columns)

    def _evidence(self, rooted: DataFrame) -> DataFrame:
        """(group, root_uid), one row per evidence."""
        groups = linkage.key_groups(rooted, self.matching).select("record_uid", "group")
        return groups.join(rooted.select("record_uid", "root_uid"), "record_uid").groupBy("group").agg(F.max("root_uid").alias("root_uid"))

    def _slots(self, records: DataFrame) -> DataFrame:
        return linkage.slot_entries(records, self.matching, self.matching.review)

    def _winners(self, rooted: DataFrame) -> DataFrame:
        return survivorship.winners(rooted.withColumnRenamed("root_uid", "cluster_id"), self.spec).withColumnRenamed("cluster_id", "root_uid")

    # ------------------------------------------------------------ increments

    def apply(self, upserts: DataFrame, removed: DataFrame, batch_id: str, as_of: str) -> Increment:
        """Take in new and changed records (one row per record_uid) and remove others (record_uid).

        Everything is read as of the batches before, so a replay of the batch gives the same again.
        """
        upserts = materialize(self._narrow(upserts), "upserts")
        changed = materialize(upserts.select("record_uid").unionByName(removed.select("record_uid")).distinct(), "changed")
        known = materialize(self.members.lookup(changed, before=batch_id), "known")
        reopened = materialize(known.select("root_uid").distinct(), "reopened")
        # All rows of the reopened entities, with what the evidence and the decisions depend on.
        compared = self.matching.columns
        held = materialize(self.entities.lookup(reopened, before=batch_id, only=compared).select("root_uid", "record_uid", *compared), "held")
        again = held.join(changed, "record_uid", "left_anti").withColumnRenamed("root_uid", "old_root")
        arrived = upserts.select("record_uid", *self.matching.columns).withColumn("old_root", F.lit(None).cast("string"))
        fresh = materialize(again.unionByName(arrived), "fresh")

        groups = materialize(linkage.key_groups(fresh, self.matching).select("record_uid", "group"), "groups")
        asked = groups.join(upserts.select("record_uid"), "record_uid", "left_semi").select("group").distinct()
        standing = materialize(self.evidence.lookup(asked, before=batch_id).join(reopened, "root_uid", "left_anti"), "standing")
        edges = self._key_edges(groups, standing)
        fuzzy = None
        if self.is_fuzzy:
            fuzzy, certain = self._fuzzy(upserts, fresh, changed, batch_id)
            edges = edges.unionByName(certain) if certain is not None else edges
        found = materialize(connected_components(edges), "found")

        assigned = materialize(fresh.select("record_uid", "old_root").join(found, F.col("record_uid") == F.col("vertex"), "left")
                               .select("record_uid", "old_root", F.coalesce("component", "record_uid").alias("root_uid")), "assigned")
        # Vertices that are no fresh records are roots of standing entities.
        met = materialize(found.join(fresh.select("record_uid"), F.col("vertex") == F.col("record_uid"), "left_anti")
                          .select(F.col("vertex").alias("old_root"), F.col("component").alias("root_uid")), "met")
        absorbed = met.filter("old_root != root_uid")
        moved = materialize(self.entities.lookup(absorbed.select(F.col("old_root").alias("root_uid")), before=batch_id)
                            .withColumnRenamed("root_uid", "old_root").join(absorbed, "old_root"), "moved")
        winners = self._maintained_winners(upserts, changed, reopened, assigned, met, batch_id).withColumn("made_on", F.lit(as_of))
        return self._write(upserts, known, reopened, held, assigned, met, moved, groups, winners, fuzzy, batch_id)

    @staticmethod
    def _key_edges(groups: DataFrame, standing: DataFrame) -> DataFrame:
        """Each evidence links its holders to the largest of them; a standing entity holds what `evidence` says."""
        holders = groups.withColumnRenamed("record_uid", "vertex").unionByName(
            standing.select(F.col("root_uid").alias("vertex"), "group")).distinct()
        top = holders.groupBy("group").agg(F.max("vertex").alias("dst"))
        return holders.join(top, "group").select(F.col("vertex").alias("src"), "dst").filter("src != dst")

    def _fuzzy(self, upserts: DataFrame, fresh: DataFrame, changed: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame | None]:
        """(fuzzy decisions that involve a new or changed record, certain edges with standing records as their root)."""
        asked = self._slots(upserts).select("slot").distinct()
        taken = fresh.select("record_uid").unionByName(changed)  # removed records and earlier versions meet nobody
        # Read twice by the lookup: for its buckets, and for the rows in them.
        near = materialize(self.slots.lookup(asked, before=batch_id).select("record_uid").distinct().join(taken, "record_uid", "left_anti"), "near")
        roots = materialize(self.members.lookup(near, before=batch_id), "near")
        stored = (self.entities.read(before=batch_id, among=roots, only=self.matching.columns).join(roots, ["root_uid", "record_uid"], "left_semi")
                  .select("root_uid", "record_uid", *self.matching.columns))
        pool = materialize(fresh.withColumnRenamed("old_root", "root_uid").withColumn("is_fresh", F.lit(True))
                           .unionByName(stored.withColumn("is_fresh", F.lit(False))), "pool")
        stands = linkage.profile_members(pool, self.matching)
        news = stands.join(upserts.select("record_uid"), "record_uid", "left_semi").select("first_uid").distinct()
        pairs = materialize(linkage.fuzzy_pairs(pool, self.matching), "fuzzy")
        ends = pairs.select("record_uid_1", "record_uid_2", F.explode(F.array("record_uid_1", "record_uid_2")).alias("end"))
        # Copies of one profile are named by its first and last record, both stand for it.
        firsts = ends.join(stands, F.col("end") == F.col("record_uid")).join(news, "first_uid", "left_semi")
        decided = pairs.join(firsts.select("record_uid_1", "record_uid_2").distinct(), ["record_uid_1", "record_uid_2"], "left_semi")
        if not self.merges_fuzzy:
            return decided, None
        edges = linkage.match_edges(pool, self.matching)
        standing = pool.filter("NOT is_fresh").select("record_uid", F.col("root_uid").alias("stored_root"))
        for end in ("src", "dst"):
            edges = (edges.join(standing.withColumnRenamed("record_uid", end), end, "left")
                     .withColumn(end, F.coalesce("stored_root", end)).drop("stored_root"))
        return decided, edges.select("src", "dst").filter("src != dst")

    def _maintained_winners(self, upserts: DataFrame, changed: DataFrame, reopened: DataFrame, assigned: DataFrame, met: DataFrame,
                            batch_id: str) -> DataFrame:
        """Winner rows of all touched entities, merged from what is known and read again where a retraction asks for it."""
        attributes = self.spec.attributes
        before = materialize(self.winners.lookup(reopened, before=batch_id), "winners")
        lost = (before.select("root_uid", F.inline(F.array(*[
            F.struct(F.lit(a).alias("attribute"), F.col(f"{a}.record_uid").alias("record_uid")) for a in attributes])))
            .join(changed, "record_uid", "left_semi").groupBy("root_uid").agg(F.collect_set("attribute").alias("lost")))  # attributes at most
        # Where the remaining records of a reopened entity went: to one entity, to several, or there are none.
        homes = (assigned.filter("old_root IS NOT NULL").groupBy("old_root")
                 .agg(F.min("root_uid").alias("home"), (F.min("root_uid") != F.max("root_uid")).alias("is_split")))
        state = materialize(homes.join(lost.withColumnRenamed("root_uid", "old_root"), "old_root", "left")
                            .withColumn("lost", F.coalesce("lost", F.array().cast("array<string>"))), "reopened-state")
        whole = (before.withColumnRenamed("root_uid", "old_root").join(state.filter("NOT is_split"), "old_root")
                 .select(F.col("home").alias("root_uid"),
                         *[F.when(~F.array_contains("lost", a), F.col(a)).alias(a) for a in attributes]))
        torn = state.filter(F.col("is_split") | (F.size("lost") > 0)).select(F.col("old_root").alias("root_uid"))
        left = (self.entities.lookup(torn, before=batch_id).join(changed, "record_uid", "left_anti").drop("root_uid")
                .join(assigned.select("record_uid", "root_uid"), "record_uid"))
        news = upserts.join(assigned.select("record_uid", "root_uid"), "record_uid")
        standing = (self.winners.lookup(met.select(F.col("old_root").alias("root_uid")), before=batch_id)
                    .withColumnRenamed("root_uid", "old_root").join(met, "old_root").select("root_uid", *attributes))
        rows = reduce(DataFrame.unionByName, [f.select("root_uid", *attributes) for f in (
            whole, self._winners(left.unionByName(news.select(*left.columns))), standing)])
        return materialize(rows.groupBy("root_uid").agg(*[F.min(a).alias(a) for a in attributes]), "winners")

    def _write(self, upserts, known, reopened, held, assigned, met, moved, groups, winners, fuzzy, batch_id) -> Increment:
        rows = (upserts.join(assigned.select("record_uid", "root_uid"), "record_uid")
                .unionByName(moved.drop("old_root")))
        # Records of reopened entities are written only where their entity has another root now.
        shifted = assigned.filter("old_root IS NOT NULL AND old_root != root_uid")
        left = (self.entities.lookup(shifted.select(F.col("old_root").alias("root_uid")), before=batch_id).drop("root_uid")
                .join(shifted.select("record_uid", "root_uid"), "record_uid"))
        rows = materialize(rows.unionByName(left.select(*rows.columns)), "entity-rows")
        changed = held.join(known.select("record_uid"), "record_uid", "left_semi")  # as they were
        gone = (changed.select("root_uid", "record_uid")
                .unionByName(shifted.select(F.col("old_root").alias("root_uid"), "record_uid"))
                .unionByName(moved.select(F.col("old_root").alias("root_uid"), "record_uid")))
        self.entities.change(rows, gone, batch_id)

        placed = materialize(rows.select("record_uid", "root_uid"), "placed")
        self.members.change(placed, known, batch_id)

        # Evidence of the records that were placed now, and of reopened entities that keep theirs.
        kept = (groups.join(assigned.select("record_uid", "root_uid"), "record_uid").select("group", "root_uid")
                .unionByName(self._evidence(moved.drop("old_root")).select("group", "root_uid")))
        now = materialize(kept.groupBy("group").agg(F.max("root_uid").alias("root_uid")), "evidence")
        then = linkage.key_groups(held.drop("root_uid"), self.matching).select("group").distinct()
        self.evidence.change(now, then.join(now, "group", "left_anti"), batch_id)

        if self.is_fuzzy:
            self.slots.change(self._slots(upserts), self._slots(changed), batch_id)

        retired = (reopened.unionByName(met.filter("old_root != root_uid").select(F.col("old_root").alias("root_uid"))).distinct()
                   .join(winners.select("root_uid"), "root_uid", "left_anti"))
        retired = materialize(retired, "retired")
        self.winners.change(winners, retired, batch_id)
        touched = winners.select("root_uid")

        everybody = self.entities.read(upto=batch_id, among=touched, only=self.matching.columns).join(touched, "root_uid", "left_semi")
        links = linkage.deterministic_decisions(everybody, self.matching)
        decisions = materialize(links if fuzzy is None else links.unionByName(fuzzy), "decisions")
        return Increment(placed, touched, retired, decisions)
