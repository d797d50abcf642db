"""Rule-driven value standardization with a per-record transform log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.functions.transforms import apply_chain
from kinfold.spec import EntitySpec


def standardize(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Replace every ruled attribute by its standardized value and log before and after.

    All chains read the raw columns of the same input, so this is one projection.
    """
    chains = {a: c for a, c in spec.standardization.items() if a in df.columns}
    clean = {a: apply_chain(F.col(a), chain) for a, chain in chains.items()}
    log = [
        F.struct(
            F.lit(a).alias("attribute"),
            F.col(a).cast("string").alias("raw_value"),
            clean[a].cast("string").alias("standardized_value"),
            F.lit("|".join(step["transform"] for step in chain)).alias("transforms_applied"),
        )
        for a, chain in chains.items()
    ]
    return df.select(*[clean[c].alias(c) if c in clean else F.col(c) for c in df.columns],
                     F.array(*log).alias("transform_log"))


def log_entries(standardized: DataFrame, *keys: str) -> DataFrame:
    return standardized.select(*keys, F.inline("transform_log"))


def changed_values(standardized: DataFrame, *keys: str) -> DataFrame:
    """Log entries whose value actually changed (null-safe)."""
    return log_entries(standardized, *keys).filter(~F.col("raw_value").eqNullSafe(F.col("standardized_value")))


def lookup_join(df: DataFrame, column: str, reference: DataFrame, key: str, value: str) -> DataFrame:
    """Reference lookup against a table: matched values are replaced, others pass through.

    Spark broadcasts the table only when its size statistics allow it.  The
    first value of a key wins, so the join can never multiply rows.
    """
    vocabulary = reference.groupBy(F.upper(F.col(key)).alias("__key")).agg(F.min(value).alias("__value"))
    joined = df.join(vocabulary, F.upper(F.col(column)) == F.col("__key"), "left")
    return joined.withColumn(column, F.coalesce("__value", column)).drop("__key", "__value")
