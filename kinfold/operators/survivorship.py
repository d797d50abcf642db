"""Attribute-level survivorship: who supplies each golden value, and why.

All attributes compete in one aggregation per cluster.  A candidate is a
struct that starts with its sort keys, so the winner is the smallest struct;
minima are combined before the shuffle, and a cluster of any size never has to
be sorted or gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.ingest import updated_at
from kinfold.spec import EntitySpec

_LAST = 2**63 - 1  # sort keys are ascending longs


def members(valid: DataFrame, clusters: DataFrame) -> DataFrame:
    return valid.join(clusters.select("record_uid", "cluster_id"), "record_uid")


def _sort_key(strategy: str, attribute: str) -> Column:
    """A strategy as an ascending number; records without the information come last."""
    key = {
        "source_precedence": F.col("trust_rank").cast("bigint"),
        "most_recent": -F.unix_micros(updated_at()),
        "non_null_longest": -F.length(attribute).cast("bigint"),
        "non_null_any": F.lit(0).cast("bigint"),
    }[strategy]
    return F.coalesce(key, F.lit(_LAST))


def _strategies(spec: EntitySpec, attribute: str) -> list[str]:
    return list(spec.survivorship.get(attribute, spec.default_strategy))


def winners(member: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per cluster with a winner struct {value, record_uid, source_id} per attribute.

    NULL values do not compete; ties on all strategies go to the smallest uid.
    """
    best = []
    for a in spec.attributes:
        keys = [_sort_key(s, a).alias(f"k{i}") for i, s in enumerate(_strategies(spec, a))]
        candidate = F.struct(*keys, F.col("record_uid"), F.col("source_id"), F.col(a).cast("string").alias("value"))
        best.append(F.min(F.when(F.col(a).isNotNull(), candidate)).alias(a))
    return member.groupBy("cluster_id").agg(*best)


def decisions(won: DataFrame, spec: EntitySpec) -> DataFrame:
    """(cluster_id, attribute, golden_value, winning_record_uid, winning_source, strategy), non-null values only."""
    rows = F.array_compact(F.array(*[
        F.when(F.col(a).isNotNull(), F.struct(
            F.lit(a).alias("attribute"), F.col(f"{a}.value").alias("golden_value"),
            F.col(f"{a}.record_uid").alias("winning_record_uid"), F.col(f"{a}.source_id").alias("winning_source"),
            F.lit("+".join(_strategies(spec, a))).alias("strategy")))
        for a in spec.attributes
    ]))
    return won.select("cluster_id", F.inline(rows))


def golden(won: DataFrame, spec: EntitySpec, batch_id: str, as_of: str) -> DataFrame:
    """One trusted record per cluster; the winners are already one row, so nothing is pivoted."""
    return won.select(F.col("cluster_id").alias("golden_id"),
                      *[F.col(f"{a}.value").alias(a) for a in spec.attributes],
                      F.lit(as_of).cast("timestamp").alias("mdm_created_ts"), F.lit(batch_id).alias("batch_id"))


def crosswalk(member: DataFrame) -> DataFrame:
    return member.select(F.col("cluster_id").alias("golden_id"), "record_uid", "source_id", "source_record_id",
                         "batch_id")


def golden_metrics(crosswalk_rows: DataFrame) -> DataFrame:
    """Golden records and linked source records, counted per entity first so both combine early."""
    sizes = crosswalk_rows.groupBy("golden_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("golden_records"), F.coalesce(F.sum("n"), F.lit(0)).alias("source_records_linked"))


def enrich(df: DataFrame, key: str, source_id: str, crosswalk_rows: DataFrame, golden_rows: DataFrame,
           columns: list[str]) -> DataFrame:
    """Bring golden values back to rows of a source system by that system's own key."""
    ids = crosswalk_rows.filter(F.col("source_id") == source_id).select("source_record_id", "golden_id")
    return (df.join(ids, df[key] == ids["source_record_id"], "left").drop("source_record_id")
            .join(golden_rows.select("golden_id", *[F.col(c).alias(f"golden_{c}") for c in columns]), "golden_id", "left"))
