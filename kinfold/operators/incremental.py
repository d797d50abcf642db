"""Working with what changed: incremental matching, upserts, change feeds, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.operators import linkage
from kinfold.operators.components import connected_components
from kinfold.session import materialize
from kinfold.spec import Matching


def match_increment(incoming: DataFrame, stored: DataFrame, clusters: DataFrame,
                    spec: Matching) -> tuple[DataFrame, DataFrame]:
    """Match new or changed records against the stored entities only.

    Returns (assignments, redirects): `record_uid, root_uid` for the incoming
    records and for members of clusters they may split, and `old_root,
    root_uid` for stored clusters that merged into another.  A stored cluster
    takes part as one vertex, its root; its members are read only if it holds a
    changed record, because then it must be formed anew.
    """
    known = clusters.select("record_uid", "root_uid")
    reopened = known.join(incoming.select("record_uid"), "record_uid", "left_semi").select("root_uid").distinct()
    again = (stored.join(known, "record_uid").join(reopened, "root_uid", "left_semi").drop("root_uid")
             .join(incoming.select("record_uid"), "record_uid", "left_anti"))
    fresh = materialize(incoming.unionByName(again, allowMissingColumns=True), "fresh")
    closed = known.join(reopened, "root_uid", "left_anti")

    touched = linkage.key_groups(fresh, spec).select(F.col("record_uid").alias("vertex"), "group")
    standing = (linkage.key_groups(stored, spec).join(touched.select("group").distinct(), "group", "left_semi")
                .join(closed, "record_uid").select(F.col("root_uid").alias("vertex"), "group"))
    groups = touched.unionByName(standing).distinct()
    top = groups.groupBy("group").agg(F.max("vertex").alias("dst"))
    edges = groups.join(top, "group").select(F.col("vertex").alias("src"), "dst")

    if linkage.reachable_evidence(spec, spec.auto_match) is not None:
        edges = edges.unionByName(_fuzzy_edges(fresh, stored, closed, spec))

    found = connected_components(edges)
    assignments = (fresh.select("record_uid").join(found.withColumnRenamed("vertex", "record_uid"), "record_uid", "left")
                   .select("record_uid", F.coalesce("component", "record_uid").alias("root_uid")))
    redirects = (closed.select(F.col("root_uid").alias("old_root")).distinct()
                 .join(found, F.col("old_root") == F.col("vertex")).filter("component != old_root")
                 .select("old_root", F.col("component").alias("root_uid")))
    return assignments, redirects


def _fuzzy_edges(fresh: DataFrame, stored: DataFrame, closed: DataFrame, spec: Matching) -> DataFrame:
    """Certain fuzzy matches with a fresh record on at least one side, stored ends replaced by their root."""
    blocks = linkage.block_keys(fresh, spec).select("block_key").distinct()
    near = (linkage.block_keys(stored.join(closed, "record_uid", "left_semi"), spec)
            .join(blocks, "block_key", "left_semi").select("record_uid").distinct())
    pool = fresh.unionByName(stored.join(near, "record_uid", "left_semi"), allowMissingColumns=True)
    edges = linkage.match_edges(pool, spec)
    root = closed.withColumnRenamed("root_uid", "stored_root")
    for end in ("src", "dst"):
        edges = (edges.join(root.withColumnRenamed("record_uid", end), end, "left")
                 .withColumn(end, F.coalesce("stored_root", end)).drop("stored_root"))
    return edges.select("src", "dst").filter("src != dst")


def apply_increment(clusters: DataFrame, assignments: DataFrame, redirects: DataFrame) -> DataFrame:
    """The cluster table after an increment: (record_uid, root_uid) of every record."""
    kept = clusters.select("record_uid", "root_uid").join(assignments.select("record_uid"), "record_uid", "left_anti")
    moved = (kept.join(redirects.withColumnRenamed("root_uid", "new_root"), F.col("root_uid") == F.col("old_root"), "left")
             .select("record_uid", F.coalesce("new_root", "root_uid").alias("root_uid")))
    return moved.unionByName(assignments)


def upsert(base: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Latest version per key over both inputs; a combinable maximum instead of a sorted window."""
    both = base.unionByName(changes)
    rest = [c for c in both.columns if c not in (key, version)]
    latest = both.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("row"))
    return latest.select(key, "row.*").select(*both.columns)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert_table(path: str, changes: DataFrame, key: str, version: str, buckets: int) -> None:
    """MERGE for plain files: rewrite only the hash buckets that received a change.

    The merged buckets are staged first, so a failed write can be repeated.
    """
    spark = changes.sparkSession
    changed = changes.withColumn("bucket", bucket_of(key, buckets))
    touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]  # at most `buckets` integers
    base = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
    merged = materialize(upsert(base.select(*changed.columns), changed, key, version), "merge")
    write_buckets(merged.drop("bucket"), path, key, buckets)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    (df.withColumn("bucket", bucket_of(key, buckets)).write.mode("overwrite").partitionBy("bucket")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def apply_changes(feed: DataFrame, key: str, sequence: list[str], op: str, deletes: tuple[str, ...] = ("D",)) -> DataFrame:
    """State after a change feed: the last operation per key by sequence, deletions removed."""
    rest = [c for c in feed.columns if c not in (key, op, *sequence)]
    last = feed.groupBy(key).agg(F.max(F.struct(*sequence, op, *rest)).alias("row"))
    return last.select(key, "row.*").filter(~F.col(op).isin(*deletes)).select(*feed.columns)


def history(changes: DataFrame, key: str, moment: str, tie: str, tracked: str, chunk: str = "day") -> DataFrame:
    """Type-2 history: one row per run of an unchanged `tracked` value, with valid_from / valid_to.

    Windows run inside (key, chunk of time); chunks of a key are chained through
    their last value and first change, one row each.  So a key that holds a
    large share of all rows is still split over many tasks.
    """
    rows = changes.select(key, moment, tie, tracked, F.date_trunc(chunk, moment).alias("chunk"))
    inside, along = Window.partitionBy(key, "chunk").orderBy(moment, tie), Window.partitionBy(key).orderBy("chunk")
    before = (rows.groupBy(key, "chunk").agg(F.max_by(F.struct(tracked), F.struct(moment, tie)).alias("last"))
              .select(key, "chunk", F.lag("last").over(along).alias("chunk_before")))
    held = F.coalesce(F.lag(F.struct(tracked)).over(inside), F.col("chunk_before"))
    changed = (rows.join(before, [key, "chunk"]).withColumn("held", held)
               .filter(F.col("held").isNull() | ~F.col("held").getField(tracked).eqNullSafe(F.col(tracked)))
               .select(key, "chunk", moment, tie, tracked))
    after = (changed.groupBy(key, "chunk").agg(F.min(moment).alias("first"))
             .select(key, "chunk", F.lead("first").over(along).alias("chunk_after")))
    until = F.coalesce(F.lead(moment).over(inside), F.col("chunk_after"))
    return (changed.join(after, [key, "chunk"])
            .select(key, tracked, F.col(moment).alias("valid_from"), until.alias("valid_to"))
            .withColumn("is_current", F.col("valid_to").isNull()))
