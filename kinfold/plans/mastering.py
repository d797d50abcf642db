"""The stages of one entity put together, as lazy frames and as a batch job on tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinfold.operators import ingest, lineage, linkage, quality, reconcile, survivorship
from kinfold.operators.entity_store import EntityStore, Increment
from kinfold.operators.standardize import standardize
from kinfold.session import materialize
from kinfold.sources import files
from kinfold.sources.tables import Layers, check_batch_id, stage_event
from kinfold.spec import KEY, EntitySpec


class Mastering:
    """Everything downstream of checked records.

    Each stage is built on first use.  Stages read by several others are
    written once to the shared folder, so nothing is recomputed and a lost
    executor re-reads a table.
    """

    def __init__(self, checked: DataFrame, spec: EntitySpec, batch_id: str, as_of: str, id_length: int = 32,
                 store: EntityStore | None = None, is_table: bool = False):
        """With a `store` its entities as of the batch take the place of matching and surveying everything.

        `is_table` tells that `checked` is a scan of a table, which need not be written again.
        """
        self.spec, self.batch_id, self.as_of, self.id_length = spec, batch_id, as_of, id_length
        self.given, self.store, self.is_table = checked, store, is_table

    @cached_property
    def checked(self) -> DataFrame:
        return self.given if self.is_table else materialize(self.given, "checked")

    @cached_property
    def valid(self) -> DataFrame:
        return quality.valid(self.checked)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.quarantine(self.checked)

    @cached_property
    def links(self) -> DataFrame:
        """Key links, part of the decisions and of the clusters."""
        return materialize(linkage.deterministic_links(self.valid, self.spec.matching), "links")

    @cached_property
    def pairs(self) -> DataFrame:
        return materialize(linkage.match_pairs(self.valid, self.spec.matching, links=self.links), "pairs")

    @cached_property
    def clusters(self) -> DataFrame:
        if self.store is not None:
            return self.store.clusters(self.id_length, self.batch_id)
        return materialize(linkage.clusters(self.valid, self.spec.matching, self.id_length, self.links), "clusters")

    @cached_property
    def members(self) -> DataFrame:
        return survivorship.members(self.valid, self.clusters)

    @cached_property
    def winners(self) -> DataFrame:
        if self.store is not None:
            return self.store.named_winners(self.id_length, self.batch_id)
        return materialize(survivorship.winners(self.members, self.spec), "winners")

    @cached_property
    def decisions(self) -> DataFrame:
        return survivorship.decisions(self.winners, self.spec)

    @cached_property
    def golden(self) -> DataFrame:
        if self.store is not None:
            return self.store.golden(self.id_length, self.batch_id)
        return survivorship.golden(self.winners, self.spec, self.batch_id, self.as_of)

    @cached_property
    def crosswalk(self) -> DataFrame:
        if self.store is not None:
            return self.store.crosswalk(self.id_length, self.batch_id)
        return survivorship.crosswalk(self.members)

    def trace(self, golden_ids: DataFrame) -> DataFrame:
        uids = materialize(lineage.member_uids(self.crosswalk, golden_ids), "member-uids")  # narrow, read by four sections
        return lineage.trace(dict(zip(lineage.SECTIONS, [
            lineage.source_records(uids, self.checked),
            lineage.transforms(uids, self.checked),
            lineage.dq_annotations(uids, quality.results(self.checked)),
            lineage.match_decisions(uids, self.pairs, linkage.profile_members(self.valid, self.spec.matching)),
            lineage.survivorship(golden_ids, self.decisions),
        ])))


def land_batch(spark: SparkSession, spec: EntitySpec, layers: Layers, root: str, batch_id: str, as_of: str,
               marks: DataFrame | None = None, landed: DataFrame | None = None) -> None:
    """Scan all registered sources, park dead letters, keep only new records, append the batch to bronze.

    `landed` are the rows of earlier batches that are still present; keys of
    full-load sources that are there but no longer in the extract are retired.
    """
    records, dead, seen, unreadable = [], [], [], []
    for source in spec.sources:
        extract = files.scan(spark, source, root)
        files.check_layout(extract, source)
        good, bad = files.split_dead_letters(extract, source)
        key = next(c for c, canonical in source.field_map.items() if canonical == KEY)
        source_id = F.lit(source.source_id)
        seen.append(good.select(ingest.record_uid(source_id, F.col(key).cast("string")).alias("record_uid"), source_id.alias("source_id")))
        unreadable.append(bad.select("source_id"))
        if source.contract:
            good, broken = quality.split_contract(good, source.contract, as_of)
            bad = bad.unionByName(broken.select(source_id.alias("source_id"), "payload", "reason"))
        records.append(ingest.to_canonical(good, source, spec, batch_id, as_of))
        dead.append(bad)
    arrived = ingest.union_sources(records)
    nobody = arrived.select("record_uid", "source_id").filter(F.lit(False))
    retired = nobody if landed is None else ingest.vanished_keys(landed, ingest.union_sources(seen), ingest.union_sources(unreadable), spec)
    layers.write(retired, "bronze", f"{spec.entity}_retired", batch_id)
    if marks is not None:
        arrived = ingest.filter_incremental(arrived, marks, spec, landed)
    layers.write(arrived, "bronze", f"{spec.entity}_raw", batch_id)
    layers.write(ingest.union_sources(dead), "bronze", "dead_letters", batch_id)


def run_batch(spark: SparkSession, spec: EntitySpec, layers: Layers, root: str, batch_id: str, as_of: str,
              previous: str | None = None, id_length: int = 32) -> Mastering:
    """One batch from landing files to golden records, every stage as a table partition of its own.

    The first batch matches everything and starts the entity store.  Later ones
    bring new and changed records, and the keys that vanished from full loads; the
    store is changed by them, and the batch's gold tables hold what they touched:
    the decisions made, the records placed, the golden records made anew and the ids
    retired.  The frames returned show all entities as of the batch.
    """
    check_batch_id(batch_id, previous)
    raw, std, checked, marked = f"{spec.entity}_raw", f"{spec.entity}_standardized", f"{spec.entity}_checked", "high_water_marks"

    def record(df: DataFrame, stage: str, metrics: dict[str, Column], source: str | None = None) -> None:
        """The audit event of a stage, stamped when the stage is done; `as_of` is the business date."""
        layers.write(stage_event(df, stage, batch_id, None, metrics, source), "ops", "audit_log", batch_id, part=("stage", stage))

    if previous is None:
        land_batch(spark, spec, layers, root, batch_id, as_of)
    else:
        earlier = F.col("batch_id") < batch_id
        marks = (layers.read("ops", marked).filter(earlier).groupBy("source_id")
                 .agg(F.max("high_water_mark").alias("high_water_mark")))
        retired = layers.read("bronze", f"{spec.entity}_retired").filter(earlier)
        landed = ingest.still_present(layers.read("bronze", raw).filter(earlier), retired)
        land_batch(spark, spec, layers, root, batch_id, as_of, marks, landed)
    bronze = layers.read("bronze", raw, batch_id)
    layers.write(ingest.high_water_marks(bronze, spec), "ops", marked, batch_id)
    record(bronze, "bronze_ingest", {"rows_ingested": F.count("*")}, "source_id")

    layers.write(standardize(bronze, spec).withColumn("rule_version", F.lit(spec.version)), "silver", std, batch_id)
    standardized = layers.read("silver", std, batch_id)
    record(standardized, "silver_standardize", {"rows_standardized": F.count("*")})
    layers.write(quality.evaluate(standardized, spec.rules, as_of), "silver", checked, batch_id)
    mine = layers.read("silver", checked, batch_id)
    layers.write(quality.results(mine), "silver", "dq_results", batch_id)
    record(mine, "dq_validation", {
        "rows_in": F.count("*"), "rows_valid": F.count_if(F.col("dq_status") != quality.QUARANTINED),
        "rows_quarantined": F.count_if(F.col("dq_status") == quality.QUARANTINED),
        "rule_failures": F.sum(F.size("dq_failures"))})

    work, increment = _matched(spark, layers, spec, mine, batch_id, as_of, previous, id_length)
    if increment is None:
        decided, placed, won, crosswalk, golden = work.pairs, work.clusters, work.decisions, work.crosswalk, work.golden
        gone = work.clusters.select(F.col("cluster_id").alias("golden_id")).filter(F.lit(False))
    else:
        decided, placed = increment.decisions, linkage.label(increment.assigned, id_length)
        named = materialize(work.store.named_winners(id_length, batch_id, increment.touched), "named")
        won, golden = survivorship.decisions(named, spec), work.store.golden_of(named)
        crosswalk = work.store.crosswalk(id_length, batch_id, increment.touched)
        gone = increment.retired.select(linkage.cluster_name(F.col("root_uid"), id_length).alias("golden_id"))
    layers.write(decided, "gold", "match_pairs", batch_id)
    layers.write(placed, "gold", "entity_clusters", batch_id)
    counted = work.winners.agg(F.count("*").alias("record_pairs")) if work.store is None else work.store.entity_count(batch_id)
    entities = counted.withColumn("decision", F.lit("entities"))
    tally = layers.read("gold", "match_pairs", batch_id).select("decision", "record_pairs").unionByName(entities)

    def listed(*decisions: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("decision").isin(*decisions), F.col("record_pairs"))), F.lit(0))
    record(tally, "identity_resolution", {
        "pairs_listed": listed(linkage.MATCH, linkage.REVIEW, linkage.REJECTED), "auto_matched": listed(linkage.MATCH),
        "review_queued": listed(linkage.REVIEW), "rejected_by_guard": listed(linkage.REJECTED), "entities": listed("entities")})

    layers.write(won, "gold", "survivorship_decisions", batch_id)
    layers.write(golden, "gold", f"golden_{spec.entity}", batch_id)
    layers.write(gone, "gold", "retired_golden_ids", batch_id)
    layers.write(crosswalk.withColumnRenamed("batch_id", "record_batch_id"), "gold", "crosswalk", batch_id)
    record(layers.read("gold", f"golden_{spec.entity}", batch_id), "golden_record", {"golden_records": F.count("*")})

    layers.write(reconcile.stage_counts(stages(layers, spec, batch_id)), "ops", "stage_counts", batch_id)
    counts = layers.read("ops", "stage_counts", batch_id).drop("batch_id")
    record(reconcile.exceptions(counts), "reconciliation", {"exceptions": F.count("*")})
    return work


def _matched(spark: SparkSession, layers: Layers, spec: EntitySpec, mine: DataFrame, batch_id: str, as_of: str, previous: str | None,
             id_length: int) -> tuple[Mastering, Increment | None]:
    store = EntityStore(spark, f"{layers.root}/store/{spec.entity}", spec)
    if previous is None:
        work = Mastering(mine, spec, batch_id, as_of, id_length, is_table=True)
        store.start(work.valid, work.clusters, batch_id, as_of)
        return work, None
    retired = layers.read("bronze", f"{spec.entity}_retired")
    history = layers.read("silver", f"{spec.entity}_checked")
    if not store.is_started():  # tables of a job that kept no store
        stored = ingest.batches_as_of(quality.valid(history), previous)
        store.start(stored, layers.read("gold", "entity_clusters", previous), previous, as_of)
    store.maintain(previous)
    arrived = ingest.batches_as_of(quality.valid(mine), batch_id)
    increment = store.apply(arrived, retired.filter(F.col("batch_id") == batch_id).select("record_uid"), batch_id, as_of)
    present = ingest.still_present(quality.valid(history), retired.filter(F.col("batch_id") <= batch_id))
    current = ingest.batches_as_of(present, batch_id).unionByName(quality.quarantine(mine))
    return Mastering(current, spec, batch_id, as_of, id_length, store), increment


def stages(layers: Layers, spec: EntitySpec, batch_id: str) -> dict[str, DataFrame]:
    """The stored tables whose counts must balance for a batch."""
    mine = layers.read("silver", f"{spec.entity}_checked", batch_id)
    return {
        "bronze": layers.read("bronze", f"{spec.entity}_raw", batch_id),
        "standardized": layers.read("silver", f"{spec.entity}_standardized", batch_id),
        "valid": quality.valid(mine),
        "quarantined": quality.quarantine(mine),
        "linked": layers.read("gold", "crosswalk", batch_id).filter(F.col("record_batch_id") == batch_id),
    }
