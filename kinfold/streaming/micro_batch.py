"""The same column transforms as Structured Streaming jobs.

Batches are identified by the epoch: a replayed epoch overwrites exactly its
own partition, so the sinks are idempotent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold.operators import incremental, linkage
from kinfold.operators.ingest import to_canonical
from kinfold.operators.quality import evaluate
from kinfold.operators.standardize import standardize
from kinfold.session import materialize
from kinfold.sources.keyed import KeyedTable
from kinfold.sources.tables import Layers
from kinfold.spec import EntitySpec, Source


def epoch_id(epoch: int) -> str:
    """Batch ids sort like their epochs."""
    return f"e{epoch:012d}"


def land(stream: DataFrame, source: Source, spec: EntitySpec, path: str, checkpoint: str, as_of: str) -> StreamingQuery:
    """Stream an extract to bronze with the batch field map; stateless, exactly once per file."""
    return (to_canonical(stream, source, spec, "stream", as_of).writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def check(stream: DataFrame, spec: EntitySpec, layers: Layers, checkpoint: str, as_of: str,
          across: Sequence[Mapping] = ()) -> StreamingQuery:
    """Standardize and validate each micro-batch; uniqueness of the entity's rules is scoped to the epoch.

    `across` are further `unique` rules that span the epochs: a key fails in every
    row but those of the first epoch that had it, and there if it is repeated (null
    keys are one key).  The keys seen are a keyed table per rule; an epoch reads the
    buckets of its own keys and adds those as a small delta.  A replayed epoch sees
    only the epochs before it.

    One write per epoch: the outcome is a partition column, so valid and
    quarantined rows need no second pass.
    """
    seen = {rule["rule_id"]: KeyedTable(layers.spark, f"{layers.root}/store/{spec.entity}_seen_{rule['rule_id']}") for rule in across}

    def one(batch: DataFrame, epoch: int) -> None:
        batch_id, columns = epoch_id(epoch), {rule["rule_id"]: list(rule["columns"]) for rule in across}
        stamped = standardize(batch.withColumn("batch_id", F.lit(batch_id)), spec)
        if across:
            stamped = materialize(stamped, "epoch")
        keys = {rule_id: stamped.select(*names).distinct() for rule_id, names in columns.items()}
        earlier = {}
        for rule_id, table in seen.items():
            if epoch > 0 and table.exists():
                table.maintain(epoch_id(epoch - 1))
                earlier[rule_id] = table.read(before=batch_id, among=keys[rule_id])
        checked = evaluate(stamped, [*spec.rules, *across], as_of, earlier=earlier)
        layers.write(checked, "silver", f"{spec.entity}_checked", batch_id, within=("dq_status",))
        for rule_id, table in seen.items():
            if rule_id in earlier:
                table.change(keys[rule_id], None, batch_id)
            else:
                table.start(keys[rule_id], columns[rule_id], columns[rule_id], batch_id)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def match(stream: DataFrame, spec: EntitySpec, layers: Layers, checkpoint: str) -> StreamingQuery:
    """Match each micro-batch of valid records against the entity store of the epochs before it."""
    records, clusters = f"{spec.entity}_store", "entity_clusters"

    def one(batch: DataFrame, epoch: int) -> None:
        incoming = batch.drop("batch_id").withColumn("batch_id", F.lit(epoch_id(epoch)))
        before = F.col("batch_id") < epoch_id(epoch)
        if epoch == 0:
            state = linkage.clusters(incoming, spec.matching).select("record_uid", "root_uid")
        else:
            stored = layers.read("silver", records).filter(before)
            last = epoch_id(epoch - 1)
            known = layers.read("gold", clusters, last)
            state = incremental.apply_increment(known, *incremental.match_increment(
                incoming, stored, known, spec.matching))
        layers.write(incoming, "silver", records, epoch_id(epoch))
        named = state.withColumn("cluster_id", linkage.cluster_name(F.col("root_uid")))
        layers.write(named, "gold", clusters, epoch_id(epoch))

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_within(stream: DataFrame, keys: list[str], moment: str, delay: str) -> DataFrame:
    """Drop repeated keys across micro-batches with bounded state."""
    return stream.withWatermark(moment, delay).dropDuplicatesWithinWatermark(keys)
