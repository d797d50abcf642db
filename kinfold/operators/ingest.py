"""Landing: canonical projection, stamping, incremental and full-load change detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.spec import KEY, UPDATED, EntitySpec, Source

STAMPS = ["record_uid", "source_id", KEY, "batch_id", "ingest_ts", "trust_rank", "raw_payload", UPDATED]


def record_uid(source_id: Column, key: Column) -> Column:
    return F.sha2(F.concat_ws("||", source_id, key), 256)


def to_canonical(df: DataFrame, source: Source, spec: EntitySpec, batch_id: str, as_of: str) -> DataFrame:
    """Rename one extract to the canonical record in a single projection.

    Only mapped columns become attributes; everything the source sent (also
    unmapped columns and nulls) is kept in `raw_payload`.
    """
    column_of = {canonical: F.col(c).cast("string") for c, canonical in source.field_map.items() if c in df.columns}
    missing = F.lit(None).cast("string")
    source_id, key = F.lit(source.source_id), column_of[KEY]
    return df.select(
        record_uid(source_id, key).alias("record_uid"),
        source_id.alias("source_id"),
        key.alias(KEY),
        F.lit(batch_id).alias("batch_id"),
        F.lit(as_of).cast("timestamp").alias("ingest_ts"),
        F.lit(source.trust_rank).alias("trust_rank"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("raw_payload"),
        column_of.get(UPDATED, missing).alias(UPDATED),
        *[column_of.get(a, missing).alias(a) for a in spec.attributes],
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def updated_at() -> Column:
    return F.try_to_timestamp(F.col(UPDATED))


def high_water_marks(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Latest source timestamp per incremental source, typed; one aggregation for all sources."""
    incremental = [s.source_id for s in spec.sources if s.load_type == "incremental"]
    return (bronze.filter(F.col("source_id").isin(*incremental)).groupBy("source_id")
            .agg(F.max(updated_at()).alias("high_water_mark")).filter("high_water_mark IS NOT NULL"))


def filter_incremental(incoming: DataFrame, marks: DataFrame, spec: EntitySpec,
                       landed: DataFrame | None = None) -> DataFrame:
    """Rows at or after their source's mark; sources without a mark pass whole.

    Rows equal to the mark or without a usable timestamp are re-read on
    purpose: `landed` removes those already stored with the same payload, so
    late rows of the marked instant are neither lost nor stored twice.  A payload is
    compared with the record's latest batch only.
    """
    # One row per registered source: its size is bounded by the spec, so it may be broadcast,
    # and a source holding most of the rows is never shuffled to one place.
    registered = [s.source_id for s in spec.sources]
    bounded = F.broadcast(marks.filter(F.col("source_id").isin(*registered)).groupBy("source_id")
                          .agg(F.max("high_water_mark").alias("high_water_mark")))

    def reaches_mark(df: DataFrame) -> DataFrame:
        moment, mark = updated_at(), F.col("high_water_mark")
        return df.join(bounded, "source_id", "left").filter(mark.isNull() | moment.isNull() | (moment >= mark))

    fresh = reaches_mark(incoming).drop("high_water_mark")
    if landed is None:
        return fresh
    # Only a record's latest batch counts: one that returns to an earlier payload has changed again.
    latest = landed.groupBy("record_uid").agg(F.max("batch_id").alias("batch_id"))
    boundary = landed.join(latest, ["record_uid", "batch_id"]).select("record_uid", F.sha2("raw_payload", 256).alias("payload_hash"))
    return (fresh.withColumn("payload_hash", F.sha2("raw_payload", 256))
            .join(boundary, ["record_uid", "payload_hash"], "left_anti").drop("payload_hash"))


def still_present(landed: DataFrame, retired: DataFrame) -> DataFrame:
    """Landed rows without those of keys that were retired later; a key that came back has its later rows."""
    last = retired.groupBy("record_uid").agg(F.max("batch_id").alias("retired_in"))
    return (landed.join(last, "record_uid", "left").filter(F.col("retired_in").isNull() | (F.col("batch_id") > F.col("retired_in")))
            .drop("retired_in"))


def vanished_keys(present: DataFrame, seen: DataFrame, unreadable: DataFrame, spec: EntitySpec) -> DataFrame:
    """(record_uid, source_id) of full-load sources that were present and are not among the keys `seen` in a new extract.

    `seen` has the keys of the whole extract, `unreadable` the sources with lines
    whose key could not be read: nobody knows who is missing there, so such a source
    retires nothing this time, and neither does one whose extract holds no key at all.
    """
    full = [s.source_id for s in spec.sources if s.load_type == "full"]
    # One row per registered source, so it may be broadcast.
    judged = F.broadcast(seen.select("source_id").distinct().join(unreadable.select("source_id").distinct(), "source_id", "left_anti"))
    held = present.filter(F.col("source_id").isin(*full)).select("record_uid", "source_id").distinct()
    return held.join(judged, "source_id", "left_semi").join(seen.select("record_uid"), "record_uid", "left_anti")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Classify the keys of two full loads as insert, update, delete or unchanged.

    Both loads are tagged and reduced per key in one combinable aggregation;
    there is no join that repeated keys could blow up.  Copies of a key are
    compared as a bag (count, extremes and sum of their hashes).
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col(key), F.lit(side).alias("side"), F.sha2(text, 256).alias("digest"),
                         F.xxhash64(text).cast("decimal(38,0)").alias("number"))

    def bag(side: str) -> Column:
        mine = F.col("side") == side
        return F.struct(F.count_if(mine).alias("n"), F.min(F.when(mine, F.col("digest"))).alias("low"),
                        F.max(F.when(mine, F.col("digest"))).alias("high"),
                        F.sum(F.when(mine, F.col("number"))).alias("total")).alias(side)

    both = tagged(old, "old").unionByName(tagged(new, "new")).groupBy(key).agg(bag("old"), bag("new"))
    change = (F.when(F.col("old.n") == 0, "insert").when(F.col("new.n") == 0, "delete")
              .when(F.col("old") != F.col("new"), "update").otherwise("unchanged"))
    return both.select(key, change.alias("change"))


def rows_ingested(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_id").agg(F.count("*").alias("rows_ingested"))


def batches_as_of(bronze: DataFrame, batch_id: str) -> DataFrame:
    """The latest version of every record as known after a batch (replay and audit)."""
    known = bronze.filter(F.col("batch_id") <= batch_id)
    rest = [c for c in bronze.columns if c not in ("record_uid", "batch_id")]
    latest = known.groupBy("record_uid").agg(F.max(F.struct("batch_id", *rest)).alias("row"))
    return latest.select("record_uid", "row.*").select(*bronze.columns)
