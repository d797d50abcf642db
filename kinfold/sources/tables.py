"""Layered tables: (layer, name) -> a directory of batches."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kinfold.spec import SpecError

LAYERS = ("bronze", "silver", "gold", "ops")


class Layers:
    """Batch-partitioned tables below one root.

    A write with a batch id replaces exactly that batch, also by no rows at all, so
    replaying is idempotent and earlier batches are kept.  Without an id it
    replaces the batches that the frame contains.  Each table keeps its columns
    in `_layout`, so a read declares them: batch ids stay text, empty tables can be
    read, and no footers are merged.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def write(self, df: DataFrame, layer: str, name: str, batch_id: str | None = None, within: tuple[str, ...] = (),
              part: tuple[str, str] | None = None) -> None:
        """`within` partitions a batch further; `part` (column, value) replaces only that part of the batch."""
        path = self.path(layer, name)
        writer = df.write if batch_id is None else df.drop("batch_id").write
        writer = writer.format(self.fmt).mode("overwrite").option("compression", "zstd")
        if batch_id is None:
            writer.partitionBy("batch_id", *within).option("partitionOverwriteMode", "dynamic").save(path)
        else:
            folder = f"{path}/batch_id={check_batch_id(batch_id)}"
            if part is not None:
                folder, writer = f"{folder}/{part[0]}={part[1]}", df.drop("batch_id", part[0]).write.format(self.fmt).mode("overwrite").option("compression", "zstd")
            (writer.partitionBy(*within) if within else writer).option("partitionOverwriteMode", "static").save(folder)
        kept = [f for f in df.schema if f.name != "batch_id"]
        self._remember(path, T.StructType([*kept, T.StructField("batch_id", T.StringType())]))

    def read(self, layer: str, name: str, batch_id: str | None = None) -> DataFrame:
        path = self.path(layer, name)
        df = self.spark.read.schema(self._layout(path)).format(self.fmt).load(path)
        return df if batch_id is None else df.filter(F.col("batch_id") == batch_id)

    def _layout(self, path: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{path}/_layout").first()["value"]))

    def _remember(self, path: str, schema: T.StructType) -> None:
        """Add columns that are new to the table's layout."""
        try:
            known = self._layout(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            known = T.StructType([])
        have = set(known.fieldNames())
        fresh = [T.StructField(f.name, f.dataType) for f in schema if f.name not in have]
        if fresh:
            text = T.StructType([*known, *fresh]).json()
            self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_layout")


def check_batch_id(batch_id: str, previous: str | None = None) -> str:
    """A batch id names a folder, and batches are ordered by their ids as text."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch_id):
        raise SpecError(f"batch id {batch_id!r}: letters, digits, dots, dashes and underscores only")
    if previous is not None and not previous < batch_id:
        raise SpecError(f"batch id {batch_id!r} does not sort behind {previous!r}")
    return batch_id


def stage_event(df: DataFrame, stage: str, batch_id: str, as_of: str | None, metrics: dict[str, Column],
                source: str | None = None) -> DataFrame:
    """Audit rows (stage, source_id, batch_id, event_ts, metrics map) from one aggregation.

    `metrics` maps a name to an aggregate Column; all of them are computed in
    the same pass.  `source` groups by that column, otherwise the row is 'ALL'.
    `as_of` fixes the event time for a replay; without it, it is the time of writing.
    """
    pairs = [v for name, agg in metrics.items() for v in (F.lit(name), agg.cast("bigint"))]
    grouped = df.groupBy(F.col(source).alias("source_id")) if source else df.groupBy()
    out = grouped.agg(F.create_map(*pairs).alias("metrics"))
    if not source:
        out = out.withColumn("source_id", F.lit("ALL"))
    return out.select(F.lit(stage).alias("stage"), "source_id", F.lit(batch_id).alias("batch_id"),
                      (F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()).alias("event_ts"), "metrics")
