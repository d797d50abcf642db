"""Operational metrics and alert conditions as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.operators.linkage import REVIEW
from kinfold.operators.quality import QUARANTINED, results


def quarantine_rates(evaluated: DataFrame) -> DataFrame:
    """Quarantined share per source, and over all sources."""
    return (evaluated.rollup("source_id").agg(
        F.grouping("source_id").alias("is_total"), F.count("*").alias("rows_in"),
        F.count_if(F.col("dq_status") == QUARANTINED).alias("rows_quarantined"))
        .select(F.when(F.col("is_total") == 1, "ALL").otherwise(F.col("source_id")).alias("source_id"), "rows_in",
                "rows_quarantined", F.round(F.col("rows_quarantined") / F.col("rows_in"), 6).alias("quarantine_rate")))


def failures_by_source_and_rule(evaluated: DataFrame) -> DataFrame:
    """Failure counts per source and rule with all subtotals (`ALL`)."""
    cubed = results(evaluated).cube("source_id", "rule_id").agg(
        F.grouping("source_id").alias("gs"), F.grouping("rule_id").alias("gr"), F.count("*").alias("failures"))
    return cubed.select(F.when(F.col("gs") == 1, "ALL").otherwise(F.col("source_id")).alias("source_id"),
                        F.when(F.col("gr") == 1, "ALL").otherwise(F.col("rule_id")).alias("rule_id"), "failures")


def review_depth(pairs: DataFrame) -> DataFrame:
    """Pairs awaiting a steward per score."""
    return (pairs.filter(F.col("decision") == REVIEW).groupBy("score")
            .agg(F.count("*").alias("queue_rows"), F.sum("record_pairs").alias("record_pairs")))


def batch_latency(events: DataFrame, batch: str, moment: str) -> DataFrame:
    """First and last event and elapsed seconds per batch."""
    return (events.groupBy(batch).agg(F.count("*").alias("n_events"), F.min(moment).alias("first_event"),
                                      F.max(moment).alias("last_event"))
            .withColumn("seconds", F.timestamp_diff("SECOND", F.col("first_event"), F.col("last_event"))))


def rate_spikes(rates: DataFrame, series: str, batch: str, rate: str, trailing: int = 7, sigmas: float = 2.0) -> DataFrame:
    """Batches whose rate exceeds the trailing mean by `sigmas` standard deviations.

    Input is already one row per series and batch, so the window is short.
    """
    past = Window.partitionBy(series).orderBy(batch).rowsBetween(-trailing, -1)
    scored = rates.select(
        series, batch, rate, F.avg(rate).over(past).alias("baseline"), F.stddev_samp(rate).over(past).alias("deviation"),
        F.count(rate).over(past).alias("n_past"))
    return (scored.filter((F.col("n_past") == trailing) & (F.col(rate) > F.col("baseline") + sigmas * F.col("deviation")))
            .drop("n_past"))


def stalled_sources(marks: DataFrame, as_of: str, max_days: int) -> DataFrame:
    """Sources whose high-water mark is older than allowed."""
    age = F.date_diff(F.lit(as_of).cast("date"), F.to_date("high_water_mark"))
    return marks.select("source_id", "high_water_mark", age.alias("days_behind")).filter(F.col("days_behind") > max_days)


def review_sla_breaches(pairs: DataFrame, records: DataFrame, as_of: str, max_days: int, stands: DataFrame) -> DataFrame:
    """Review pairs waiting longer than allowed, measured from the later of two records.

    A listed pair stands for all pairs of copies of its two profiles (`stands`:
    record_uid, first_uid).  From the dates of each profile's records follow, without
    forming a pair, how many of them are late (`late_pairs`) and how long the
    longest waits.  A record without a date waits since its partner's.
    """
    cutoff = F.date_sub(F.lit(as_of).cast("date"), max_days)
    dated = stands.join(records.select("record_uid", F.expr("try_cast(source_updated_at AS DATE)").alias("day")), "record_uid")
    queue = pairs.filter(F.col("decision") == REVIEW)
    # The first record by date, and the first of the others: what two copies of one profile can wait since.
    first = dated.groupBy("first_uid").agg(F.min(F.when(F.col("day").isNotNull(), F.struct("day", "record_uid"))).alias("one"))
    other = dated.join(first, "first_uid").filter(F.col("one").isNotNull() & (F.col("record_uid") != F.col("one.record_uid")))
    second = other.groupBy("first_uid").agg(F.min("day").alias("second_day"))
    ages = (dated.groupBy("first_uid").agg(
        F.min("day").alias("day"), F.count_if(F.col("day").isNull()).alias("undated"),
        F.count_if(F.coalesce(F.col("day") < cutoff, F.lit(True))).alias("old")).join(second, "first_uid", "left"))
    # A pair inside one profile names its first and last record, and only the first names a profile.
    ends = queue.join(stands.select(F.col("record_uid").alias("record_uid_2"), F.col("first_uid").alias("p2")), "record_uid_2")
    for side, uid in (("1", "record_uid_1"), ("2", "p2")):
        renamed = ages.select(F.col("first_uid").alias(uid), *[F.col(c).alias(f"{c}_{side}") for c in ages.columns[1:]])
        ends = ends.join(renamed, uid)
    same = F.col("record_uid_1") == F.col("p2")

    def two_of(n: str) -> Column:
        return F.expr(f"{n} * ({n} - 1) div 2")
    late = F.when(same, two_of("old_1") - two_of("undated_1")).otherwise(
        F.col("old_1") * F.col("old_2") - F.col("undated_1") * F.col("undated_2"))
    both = F.when(F.col("day_1").isNotNull() & F.col("day_2").isNotNull(), F.greatest("day_1", "day_2"))
    since = F.when(same, F.least("second_day_1", F.when(F.col("undated_1") > 0, F.col("day_1")))).otherwise(
        F.least(both, F.when(F.col("undated_1") > 0, F.col("day_2")), F.when(F.col("undated_2") > 0, F.col("day_1"))))
    return (ends.withColumn("late_pairs", late).filter("late_pairs > 0")
            .select("record_uid_1", "record_uid_2", "score", "late_pairs",
                    F.date_diff(F.lit(as_of).cast("date"), since).alias("days_waiting")))


def alerts(conditions: dict[str, DataFrame]) -> DataFrame:
    """How many rows each alert condition returns; quiet conditions are listed with 0."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("occurrences")).select(F.lit(name).alias("alert"), "occurrences")
        for name, df in conditions.items()])
