"""Lineage of golden records, for any number of ids at once.

`golden_ids` is a DataFrame with a `golden_id` column: tracing one entity and
tracing all of them is the same set of equi-joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kinfold.session import materialize


SECTIONS = ["source_records", "transforms", "dq_annotations", "match_decisions", "survivorship_decisions"]


def member_uids(crosswalk: DataFrame, golden_ids: DataFrame) -> DataFrame:
    return crosswalk.join(golden_ids.select("golden_id").distinct(), "golden_id", "left_semi").select("golden_id", "record_uid")


def source_records(uids: DataFrame, standardized: DataFrame) -> DataFrame:
    return uids.join(standardized.select("record_uid", "source_id", "source_record_id", "raw_payload"), "record_uid")


def transforms(uids: DataFrame, standardized: DataFrame) -> DataFrame:
    """Transforms that changed a value; a record's entries travel as one array."""
    entries = standardized.select("record_uid", F.filter("transform_log", lambda e: ~e["raw_value"].eqNullSafe(e["standardized_value"])).alias("entries"))
    return uids.join(entries.filter(F.size("entries") > 0), "record_uid").select("record_uid", "golden_id", F.inline("entries"))


def dq_annotations(uids: DataFrame, dq_results: DataFrame) -> DataFrame:
    return uids.join(dq_results.select("record_uid", "rule_id", "severity", "description"), "record_uid")


def match_decisions(uids: DataFrame, match_pairs: DataFrame, stands: DataFrame) -> DataFrame:
    """Decisions touching a member on either side; one listing per entity and pair.

    A key link names its records.  Any other pair names the first record of two
    profiles and holds for all their copies, so members meet it through `stands`
    (record_uid, first_uid); `record_pairs` says how many pairs it stands for.
    Each pair is keyed by both ends and joined once, instead of an OR join.
    """
    # What a record is found under: its own uid for key links, its profile's for the rest.
    known = uids.join(stands, "record_uid").select("golden_id", F.inline(F.array(
        F.struct(F.lit("deterministic").alias("method"), F.col("record_uid").alias("end")),
        F.struct(F.lit("probabilistic").alias("method"), F.col("first_uid").alias("end"))))).distinct()
    ends = match_pairs.select("*", F.explode(F.array("record_uid_1", "record_uid_2")).alias("end"))
    return ends.join(known, ["method", "end"]).select(
        "golden_id", "record_uid_1", "record_uid_2", "record_pairs", "score", "method", "decision").distinct()


def survivorship(golden_ids: DataFrame, decisions: DataFrame) -> DataFrame:
    wanted = golden_ids.select("golden_id").distinct()
    return (decisions.withColumnRenamed("cluster_id", "golden_id").join(wanted, "golden_id", "left_semi")
            .select("golden_id", "attribute", "golden_value", "winning_source", "strategy"))


def trace(sections: dict[str, DataFrame]) -> DataFrame:
    """All evidence as (golden_id, section, evidence JSON) rows.

    The document of one entity is its rows in order.  It stays rows on
    purpose: an entity with very many members never becomes one giant value.
    """
    parts = [
        df.select("golden_id", F.lit(name).alias("section"),
                  F.to_json(F.struct(*[c for c in df.columns if c != "golden_id"]), {"ignoreNullFields": "false"})
                  .alias("evidence"))
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def documents(traced: DataFrame, items: int = 1000) -> DataFrame:
    """Nested documents: (golden_id, section, part, evidence), about `items` pieces of evidence each.

    The shape is the same for every entity: the parts of a section are numbered
    from 0 by a hash of the evidence, as many as its number of items asks for, so
    no row grows with the size of an entity.  The evidence is written first: it is
    counted and then placed, and making it takes all joins of the trace.
    """
    traced = materialize(traced, "traced")
    sizes = traced.groupBy("golden_id", "section").agg(F.ceil(F.count("*") / items).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("evidence"), F.col("parts")).cast("int").alias("part")
    return (traced.join(sizes, ["golden_id", "section"]).groupBy("golden_id", "section", part)
            .agg(F.sort_array(F.collect_list("evidence")).alias("evidence")))


def sample_entities(crosswalk: DataFrame, least_members: int = 3, limit: int = 1) -> DataFrame:
    """The largest entities with at least so many members; ties by id."""
    sizes = crosswalk.groupBy("golden_id").agg(F.count("*").alias("n_members"))
    return sizes.filter(F.col("n_members") >= least_members).orderBy(F.desc("n_members"), "golden_id").limit(limit)
