"""Keyed tables in hash buckets, changed by small delta batches."""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from kinfold.sources.tables import check_batch_id
from kinfold.spec import SpecError

ROWS_PER_BUCKET = 500_000
DELTAS = 16  # delta batches after which `maintain` folds them into a new base

STAMP, BUCKET, GONE = "changed_in", "bucket", "gone"


class KeyedTable:
    """The current row of every key; a change writes only itself, and a lookup reads only the buckets of its keys.

    `<path>/generation=<n>/changed_in=<batch>/bucket=<b>`: a generation starts with
    all rows, later batches add the rows they changed or removed.  The last batch
    that names a key decides.  A batch that is written again replaces itself.  The
    number of buckets follows from the rows at the start of a generation and is kept
    with it in `_generations`, written last, so a failed fold leaves the old one in use.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: list[dict] | None = None

    # ------------------------------------------------------------ generations

    def _generations(self) -> list[dict]:
        """One small row per fold, read once: a table has one writer at a time."""
        if self._known is not None:
            return self._known
        try:
            rows = self.spark.read.text(f"{self.path}/_generations/*").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        self._known = sorted((json.loads(r["value"]) for r in rows), key=lambda g: g["number"])
        return self._known

    def start(self, rows: DataFrame, key: list[str], spread_by: list[str], batch_id: str, buckets: int | None = None) -> None:
        """Replace everything by `rows`; `key` names a row, `spread_by` (some of it) its bucket."""
        known = self._generations()
        number = known[-1]["number"] + 1 if known else 0
        if buckets is None:
            buckets = max(1, math.ceil(rows.count() / ROWS_PER_BUCKET))
        columns = [*key, *[c for c in rows.columns if c not in key]]
        generation = {"number": number, "key": key, "spread_by": spread_by, "buckets": buckets, "since": check_batch_id(batch_id),
                      "schema": rows.select(*columns).schema.jsonValue()}
        self._write(rows.select(*columns, F.lit(False).alias(GONE)), generation, batch_id)
        record = self.spark.createDataFrame([(json.dumps(generation),)], "value string")
        record.coalesce(1).write.mode("overwrite").text(f"{self.path}/_generations/{number:06d}")
        self._known = [*known, generation]

    def exists(self) -> bool:
        return bool(self._generations())

    def since(self) -> str:
        """The batch of the present base."""
        return self._current()["since"]

    def _current(self) -> dict:
        known = self._generations()
        if not known:
            raise SpecError(f"no table at {self.path}")
        return known[-1]

    def _folder(self, generation: dict) -> str:
        return f"{self.path}/generation={generation['number']:06d}"

    def _write(self, rows: DataFrame, generation: dict, batch_id: str) -> None:
        bucket = self._bucket([F.col(c) for c in generation["spread_by"]], generation)
        # Buckets are whole files where small; adaptive execution cuts a bucket that holds a large share of the rows.
        (rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(f"{self._folder(generation)}/{STAMP}={check_batch_id(batch_id)}"))

    @staticmethod
    def _bucket(values: list[Column], generation: dict) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(generation["buckets"])).cast("int")

    # ------------------------------------------------------------ changes

    def change(self, upserts: DataFrame, removed: DataFrame | None, batch_id: str) -> None:
        """Write the rows of a batch: `upserts` have all columns, `removed` the key; a key in both is an upsert."""
        generation = self._current()
        if not generation["since"] < batch_id:
            raise SpecError(f"batch {batch_id!r} is part of the base since {generation['since']!r}")
        schema, key = T.StructType.fromJson(generation["schema"]), generation["key"]
        rows = upserts.select(*schema.fieldNames(), F.lit(False).alias(GONE))
        if removed is not None:
            gone = removed.select(*key).distinct().join(upserts.select(*key), key, "left_anti")
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in key]
            rows = rows.unionByName(gone.select(*key, *nothing, F.lit(True).alias(GONE)))
        self._write(rows, generation, batch_id)

    def maintain(self, batch_id: str, deltas: int = DELTAS) -> bool:
        """Fold the deltas up to a batch into a new generation, once there are more than `deltas`."""
        generation = self._current()
        if self._stored(generation).select(STAMP).distinct().count() <= deltas + 1:
            return False
        self.start(self.read(), generation["key"], generation["spread_by"], batch_id)
        return True

    # ------------------------------------------------------------ reading

    def _stored(self, generation: dict) -> DataFrame:
        schema = T.StructType.fromJson(generation["schema"]).add(GONE, T.BooleanType()).add(STAMP, T.StringType()).add(BUCKET, T.IntegerType())
        return self.spark.read.schema(schema).parquet(self._folder(generation))

    def read(self, before: str | None = None, upto: str | None = None, among: DataFrame | None = None,
             stamped: bool = False, only: list[str] | None = None) -> DataFrame:
        """The current rows, or those before or up to a batch; `among` (columns of `spread_by`) limits to their buckets.

        `only` names the columns wanted besides the key: others are neither read nor moved.
        `stamped` adds the batch that wrote the row as `changed_in` (a fold counts as its batch).  The buckets come to the driver as integers, at most as many as the table has, and prune the scan.
        """
        generation = self._current()
        stored = self._stored(generation)
        for limit, kept in ((before, lambda b: F.col(STAMP) < b), (upto, lambda b: F.col(STAMP) <= b)):
            if limit is not None:
                if limit < generation["since"] or (limit == generation["since"] and before is not None):
                    raise SpecError(f"the rows before {limit!r} were folded into the base of {generation['since']!r}")
                stored = stored.filter(kept(limit))
        if among is not None:
            wanted = among.select(self._bucket([F.col(c) for c in generation["spread_by"]], generation).alias(BUCKET)).distinct()
            stored = stored.filter(F.col(BUCKET).isin([r[0] for r in wanted.collect()]))
        key = generation["key"]
        rest = [f["name"] for f in generation["schema"]["fields"] if f["name"] not in key and (only is None or f["name"] in only)]
        shown = [*rest, STAMP] if stamped else rest
        last = stored.groupBy(*key).agg(F.max_by(F.struct(GONE, *shown), STAMP).alias("row")).filter(f"NOT row.{GONE}")
        return last.select(*key, *[F.col(f"row.{c}").alias(c) for c in shown])

    def versions(self) -> DataFrame:
        """Every state of every key over all generations: its columns, `recorded_from` and `recorded_to` (batch ids).

        Runs of batches that leave a row as it was are one version, and so is a row that a
        fold repeats.  A null `recorded_to` is the present state; a removed key has no version
        from its removal on.  The rows known as of a batch b are those with recorded_from <= b
        and (recorded_to is null or b < recorded_to).
        """
        known = self._generations()
        if not known:
            raise SpecError(f"no table at {self.path}")
        key, rest = known[-1]["key"], [f["name"] for f in known[-1]["schema"]["fields"] if f["name"] not in known[-1]["key"]]
        # A key that was removed before a fold is not in its base: its removal is in the generation before.
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [self._stored(g).withColumn("generation", F.lit(g["number"])) for g in known])
        each = rows.groupBy(*key, STAMP).agg(F.max_by(F.struct(F.struct(GONE, *rest).alias("state")), "generation").alias("last"))
        along = Window.partitionBy(*key).orderBy(STAMP)
        states = each.select(*key, STAMP, F.col("last.state").alias("state"))
        before = F.lag("state").over(along)
        changed = states.withColumn("before", before).filter(F.col("before").isNull() | ~F.col("state").eqNullSafe(F.col("before"))).drop("before")
        return (changed.withColumn("recorded_to", F.lead(STAMP).over(along)).filter(f"NOT state.{GONE}")
                .select(*key, *[F.col(f"state.{c}").alias(c) for c in rest], F.col(STAMP).alias("recorded_from"), "recorded_to"))

    def lookup(self, keys: DataFrame, before: str | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows whose `spread_by` values are among those of `keys`."""
        spread_by = self._current()["spread_by"]
        wanted = keys.select(*spread_by).distinct()
        return self.read(before=before, among=wanted, only=only).join(wanted, spread_by, "left_semi")
