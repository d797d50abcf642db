"""Erasure of persons from all layers, through an index of identity keys to the batches that hold them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.ingest import record_uid
from kinfold.operators.privacy import subject_members
from kinfold.operators.quality import QUARANTINED
from kinfold.session import materialize
from kinfold.sources.keyed import KeyedTable
from kinfold.sources.tables import Layers
from kinfold.spec import EntitySpec

UIDS = ("record_uid", "record_uid_1", "record_uid_2")
#: What separates values in an unreadable line or a parked payload.
_TOKEN = r"""[^\s,;:|"'{}\[\]<>]+"""


def _key(kind: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.sha2(F.concat_ws("||", F.lit(kind), value), 256))


def _each(kind: str, words: Column) -> Column:
    return F.transform(words, lambda w: _key(kind, F.lower(w)))


class SubjectIndex:
    """(key, layer, name, held_in): the batches of each table that hold an identity key, in hash buckets.

    Keys are hashes of record uids and of identity values (trimmed, lower case),
    both also of every word of a dead letter, which names a record by its source's
    key.  An erasure reads the buckets of its keys and rewrites the batches named
    there, nothing else.  `within` names the partition columns of tables that have any.

    Values that hold a separator are not found in dead letters; null values are no keys.
    """

    def __init__(self, layers: Layers, spec: EntitySpec, identity: Sequence[str] = ("email",), within: dict[str, tuple[str, ...]] | None = None):
        self.layers, self.spec, self.identity, self.within = layers, spec, tuple(identity), within or {}
        self.table = KeyedTable(layers.spark, f"{layers.root}/store/{spec.entity}_subjects")
        self.checked = f"{spec.entity}_checked"
        self.by_record = [("bronze", f"{spec.entity}_raw"), ("bronze", f"{spec.entity}_retired"), ("bronze", "dead_letters"),
                          ("silver", f"{spec.entity}_standardized"), ("silver", self.checked), ("silver", "dq_results"),
                          ("gold", "match_pairs"), ("gold", "entity_clusters"), ("gold", "crosswalk")]
        self.by_entity = [("gold", f"golden_{spec.entity}", "golden_id"), ("gold", "survivorship_decisions", "cluster_id"),
                          ("gold", "retired_golden_ids", "golden_id")]

    def _read(self, layer: str, name: str, batches: Sequence[str]) -> DataFrame | None:
        try:
            return self.layers.read(layer, name).filter(F.col("batch_id").isin(list(batches)))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _keys(self, df: DataFrame) -> Column:
        """All keys of a row as an array."""
        if "payload" in df.columns:
            words = F.regexp_extract_all("payload", F.lit(_TOKEN), F.lit(0))
            uids = F.transform(words, lambda w: _key("uid", record_uid(F.col("source_id"), w)))
            return F.array_distinct(F.concat(uids, *[_each(a, words) for a in self.identity]))
        keys = [_key("uid", F.col(c)) for c in UIDS if c in df.columns]
        keys += [_key(a, F.lower(F.trim(a))) for a in self.identity if a in df.columns]
        return F.array_distinct(F.array_compact(F.array(*keys)))

    def index_batch(self, batch_id: str) -> None:
        """Add what the tables hold of a batch; done again, it replaces itself."""
        rows = []
        for layer, name in self.by_record:
            df = self._read(layer, name, [batch_id])
            if df is not None:
                keys = df.select(F.explode(self._keys(df)).alias("key")).distinct()
                rows.append(keys.select("key", F.lit(layer).alias("layer"), F.lit(name).alias("name"), F.lit(batch_id).alias("held_in")))
        every = reduce(DataFrame.unionByName, rows)
        if not self.table.exists() or self.table.since() == batch_id:
            self.table.start(every, ["key", "layer", "name", "held_in"], ["key"], batch_id)
        else:
            self.table.change(every, None, batch_id)

    def _batches(self, keys: DataFrame) -> dict[tuple[str, str], list[str]]:
        """The batches per table that hold any of the keys: names of folders, not rows."""
        found = self.table.lookup(keys).select("layer", "name", "held_in").distinct().collect()
        out: dict[tuple[str, str], list[str]] = {}
        for r in found:
            out.setdefault((r["layer"], r["name"]), []).append(r["held_in"])
        return out

    def _with(self, df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        """Rows that have one of the keys (`left_semi`) or none (`left_anti`)."""
        if how == "left_semi":  # a row comes once per key of it that is asked for
            listed = df.withColumn("subject_key", F.explode(self._keys(df)))
            return listed.join(keys.withColumnRenamed("key", "subject_key"), "subject_key", "left_semi").drop("subject_key")
        # Rows are named by a hash of all their columns, so equal rows go together.
        marked = df.withColumn("subject_row", F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256))
        gone = self._with(marked, keys, "left_semi").select("subject_row").distinct()
        return marked.join(gone, "subject_row", "left_anti").drop("subject_row")

    def keys_of(self, subjects: DataFrame, crosswalk: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(uid keys, all keys) of the entities: of their records, and of quarantined records that no entity has but that share an identity value."""
        uids = subject_members(subjects, crosswalk).select("record_uid").distinct()
        keys = materialize(uids.select(_key("uid", F.col("record_uid")).alias("key")), "subject-uids")
        stored = self._read("silver", self.checked, self._batches(keys).get(("silver", self.checked), []))
        if stored is None:
            return keys, keys
        own = self._with(stored, keys, "left_semi")
        values = materialize(own.select(F.explode(self._keys(own)).alias("key")).distinct(), "subject-values")
        also = self._read("silver", self.checked, self._batches(values).get(("silver", self.checked), []))
        stray = (self._with(also.filter(F.col("dq_status") == QUARANTINED), values, "left_semi")
                 .join(crosswalk.select("record_uid"), "record_uid", "left_anti").select(_key("uid", F.col("record_uid")).alias("key")))
        uid_keys = materialize(keys.unionByName(stray).distinct(), "subject-uids")
        return uid_keys, materialize(uid_keys.unionByName(values).distinct(), "subject-keys")

    def erase(self, subjects: DataFrame, crosswalk: DataFrame, erasure_id: str) -> list[tuple[str, str, str]]:
        """Remove whole entities (`golden_id`, by the present crosswalk) from every table; returns the (layer, name, batch) rewritten.

        Rows go by record uid, dead letters also by identity value.  Entity rows go in
        the batches whose crosswalk places a subject's record in that entity.  Each
        batch is written aside before it replaces the stored one, so an erasure that
        broke off is done again.  The index forgets the keys as of `erasure_id`, which
        sorts behind all batches; an entity store forgets them by `apply` with the same uids.
        """
        uid_keys, every = self.keys_of(subjects, crosswalk)
        batches = self._batches(every)
        places = batches.get(("gold", "crosswalk"), [])
        held = self._read("gold", "crosswalk", places) if places else None
        owned = None if held is None else materialize(
            self._with(held, uid_keys, "left_semi").select("golden_id", "batch_id").distinct(), "subject-entities")
        done = []
        if owned is not None:
            for layer, name, column in self.by_entity:
                stored = self._read(layer, name, places)
                if stored is not None:
                    ids = owned.withColumnRenamed("golden_id", column)
                    done += self._replace(layer, name, places, stored.join(ids, [column, "batch_id"], "left_anti").select(*stored.columns))
        # The crosswalk last: it says which entities are to go, should this be done again.
        for layer, name in sorted(self.by_record, key=lambda t: (t[1] == "crosswalk", t[1] == self.checked)):
            if (layer, name) in batches:
                keys = every if name == "dead_letters" else uid_keys
                stored = self._read(layer, name, batches[layer, name])
                done += self._replace(layer, name, batches[layer, name], self._with(stored, keys, "left_anti").select(*stored.columns))
        none = self.table.read().filter(F.lit(False))
        self.table.change(none, self.table.lookup(uid_keys), erasure_id)
        return done

    def _replace(self, layer: str, name: str, batches: Sequence[str], kept: DataFrame) -> list[tuple[str, str, str]]:
        aside = materialize(kept, "kept")
        for batch_id in batches:
            self.layers.write(aside.filter(F.col("batch_id") == batch_id), layer, name, batch_id, within=self.within.get(name, ()))
        return [(layer, name, b) for b in batches]
