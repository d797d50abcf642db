"""One query per operator over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kinfold.operators import (evaluate, incremental, ingest, lineage, linkage, monitor, privacy, quality, reconcile,
                               standardize, survivorship)
from kinfold.operators.subjects import SubjectIndex
from kinfold.plans import contacts, entities
from kinfold.plans.customer import AS_OF, ATTRIBUTES, CUSTOMER
from kinfold.plans.mastering import Mastering, run_batch
from kinfold.session import materialize, scratch_path
from kinfold.sources import files
from kinfold.sources.keyed import KeyedTable
from kinfold.sources.tables import Layers, stage_event
from kinfold.spec import Source
from kinfold.streaming import micro_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MATCHING = CUSTOMER.matching


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mastering(spark: SparkSession, sf_dir: str) -> Mastering:
    return Mastering(contacts.checked(spark, sf_dir), CUSTOMER, "b1", AS_OF)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records without payload and log, which no comparison reads."""
    narrow = quality.valid(contacts.checked(spark, sf_dir)).select(
        "record_uid", "source_id", "source_record_id", "batch_id", "source_updated_at", *ATTRIBUTES)
    return materialize(narrow, "valid")


def longs(df: DataFrame, *columns: str) -> DataFrame:
    """Exact counts are decimals; the results here fit a long (overflow is an error, not a wrong number)."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------------ scans and landing

def _written(spark: SparkSession, sf_dir: str, source_id: str, fmt: str, **options) -> tuple[Source, DataFrame, str]:
    source = CUSTOMER.source(source_id)
    root = scratch_path(spark, "landing")
    extract = contacts.extract(contacts.customers(spark, sf_dir), source)
    folder = f"{root}/{source.path.rsplit('/', 1)[0]}"
    extract.write.format(fmt).options(**options).save(folder)
    # Spark names its own files; the registered glob differs in the suffix only.
    relaxed = Source(**{**source.__dict__, "path": source.path.rsplit("/", 1)[0] + "/part-*"})
    return relaxed, extract, root


@query
def scan_csv(spark, sf_dir):
    source, _, root = _written(spark, sf_dir, "CRM", "csv", header=True, ignoreLeadingWhiteSpace=False,
                               ignoreTrailingWhiteSpace=False)
    return files.scan(spark, source, root).drop(files.CORRUPT)


@query
def scan_delimited(spark, sf_dir):
    source, _, root = _written(spark, sf_dir, "LEGACY", "csv", header=True, sep="|")
    return files.scan(spark, source, root).drop(files.CORRUPT)


@query
def scan_ndjson(spark, sf_dir):
    source, _, root = _written(spark, sf_dir, "WEB", "json")
    return files.scan(spark, source, root).drop(files.CORRUPT)


@query
def dead_letter(spark, sf_dir):
    """Orders written as text with some lines cut short: those lines come back whole, with a reason."""
    orders = table(spark, sf_dir, "orders")
    source = Source(source_id="ORDERS", format="csv", path="orders/part-*", options={"sep": "|", "header": "false"},
                    field_map={"o_orderkey": "source_record_id", "status": "status", "total": "total"})
    line = F.when(F.col("o_orderstatus") == "P", F.concat_ws("|", F.lit(""), "o_orderstatus", "o_orderpriority")) \
        .when(F.col("o_orderpriority") == "5-LOW", F.concat_ws("|", "o_orderkey", "o_orderstatus")) \
        .otherwise(F.concat_ws("|", "o_orderkey", "o_orderstatus", "o_orderpriority"))
    root = scratch_path(spark, "landing")
    orders.select(line.alias("value")).write.text(f"{root}/orders")
    schema = T.StructType([*source.schema, T.StructField(files.CORRUPT, T.StringType())])
    scanned = (spark.read.schema(schema).options(sep="|", columnNameOfCorruptRecord=files.CORRUPT)
               .csv(f"{root}/{source.path}"))
    _, dead = files.split_dead_letters(scanned, source)
    return dead.groupBy("source_id", "reason", "payload").agg(F.count("*").alias("n_lines"))


@query
def ingest_union(spark, sf_dir):
    return (contacts.bronze(spark, sf_dir).drop("raw_payload")
            .withColumn("ingest_ts", stamp("ingest_ts")))


@query
def raw_payload(spark, sf_dir):
    return contacts.bronze(spark, sf_dir).select("record_uid", "source_id", "raw_payload")


@query
def rows_ingested(spark, sf_dir):
    return ingest.rows_ingested(contacts.bronze(spark, sf_dir))


@query
def high_water_marks(spark, sf_dir):
    marks = ingest.high_water_marks(contacts.bronze(spark, sf_dir), CUSTOMER)
    return marks.withColumn("high_water_mark", stamp("high_water_mark"))


def _earlier(bronze: DataFrame) -> DataFrame:
    """What an earlier run landed: the initial loads and the sign-ups of two cities."""
    return bronze.filter("source_updated_at < '2026-06-10' OR (source_id = 'WEB' AND city IN ('Delhi', 'Bombay'))")


@query
def ingest_incremental(spark, sf_dir):
    bronze = contacts.bronze(spark, sf_dir)
    landed = _earlier(bronze)
    fresh = ingest.filter_incremental(bronze, ingest.high_water_marks(landed, CUSTOMER), CUSTOMER, landed)
    return fresh.select("record_uid", "source_id", "source_record_id", "source_updated_at")


@query
def snapshot_diff(spark, sf_dir):
    """Two full loads of LEGACY: the later one lost some customers, gained some and moved others."""
    customer = contacts.customers(spark, sf_dir)
    legacy = contacts.extract(customer, CUSTOMER.source("LEGACY"))
    segment = customer.select(F.concat(F.lit("L"), F.col("c_custkey")).alias("CUST_NO"), "c_mktsegment")
    both = legacy.join(segment, "CUST_NO")
    old = both.filter("c_mktsegment != 'BUILDING'")
    new = both.filter("c_mktsegment != 'MACHINERY'").withColumn(
        "CITY", F.when(F.col("c_mktsegment") == "FURNITURE", "PUNE").otherwise(F.col("CITY")))
    return ingest.snapshot_diff(old, new, "CUST_NO", legacy.columns)


@query
def contract_violations(spark, sf_dir):
    """Expectations on a raw extract, before it is landed."""
    rules = [
        {"rule_id": "C001", "rule_type": "regex", "column": "contact_email", "allow_null": True, "severity": "ERROR",
         "pattern": "@EXAMPLE[.]COM$", "description": "E-mail arrives in upper case from the sign-up form"},
        {"rule_id": "C002", "rule_type": "not_null", "column": "mobile", "severity": "ERROR",
         "description": "Mobile is part of the contract"},
    ]
    extract = contacts.extract(contacts.customers(spark, sf_dir), CUSTOMER.source("WEB"))
    return quality.results(quality.evaluate(extract, rules, AS_OF), "user_id").select("user_id", "rule_id", "severity")


@query
def layered_tables(spark, sf_dir):
    """Three batches: one replayed with other rows, one with none; ids that look like numbers; only its own partition changes."""
    layers = Layers(spark, scratch_path(spark, "layers"))
    bronze = contacts.bronze(spark, sf_dir)
    layers.write(bronze.filter("source_id = 'CRM'"), "bronze", "customer_raw", "007")
    layers.write(bronze.filter("source_id = 'WEB'"), "bronze", "customer_raw", "010")
    layers.write(bronze.filter("source_id = 'WEB'"), "bronze", "customer_raw", "011")
    layers.write(bronze.filter("source_id = 'LEGACY'"), "bronze", "customer_raw", "010")
    layers.write(bronze.filter("source_id = 'NONE'"), "bronze", "customer_raw", "011")
    return layers.read("bronze", "customer_raw").groupBy("batch_id", "source_id").agg(F.count("*").alias("n_rows"))


@query
def audit_log(spark, sf_dir):
    checked = materialize(contacts.checked(spark, sf_dir), "checked")
    events = ingest.union_sources([
        stage_event(checked, "bronze_ingest", "b1", AS_OF, {"rows_ingested": F.count("*")}, source="source_id"),
        stage_event(checked, "dq_validation", "b1", AS_OF, {
            "rows_in": F.count("*"), "rows_valid": F.count_if(F.col("dq_status") != quality.QUARANTINED),
            "rows_quarantined": F.count_if(F.col("dq_status") == quality.QUARANTINED)}),
    ])
    return events.select("stage", "source_id", "batch_id", F.explode("metrics").alias("metric", "amount"))


@query
def rule_version(spark, sf_dir):
    """Every standardized row carries the hash of the rules that made it."""
    stamped = contacts.silver(spark, sf_dir).withColumn("rule_version", F.lit(CUSTOMER.version))
    return stamped.groupBy("batch_id", "rule_version").agg(F.count("*").alias("n_rows"))


@query
def replay_as_of(spark, sf_dir):
    """Bronze as known after June: later versions of a record do not exist yet."""
    batches = contacts.bronze(spark, sf_dir).withColumn("batch_id", F.substring("source_updated_at", 1, 10))
    return ingest.batches_as_of(batches, "2026-06-01").select("record_uid", "source_id", "batch_id", "email")


# ------------------------------------------------------------------ standardization

def _standardized(attribute: str) -> Query:
    def run(spark, sf_dir):
        return contacts.silver(spark, sf_dir).groupBy("source_id", "source_record_id", attribute).agg(
            F.count("*").alias("n_rows"))

    run.__name__ = f"std_{attribute}"
    return run


for _attribute in ATTRIBUTES:
    query(_standardized(_attribute))


@query
def transform_log(spark, sf_dir):
    return standardize.log_entries(contacts.silver(spark, sf_dir), "record_uid", "source_updated_at")


@query
def changed_values(spark, sf_dir):
    changed = standardize.changed_values(contacts.silver(spark, sf_dir), "source_id")
    return changed.groupBy("source_id", "attribute", "transforms_applied").agg(F.count("*").alias("n_changed"))


@query
def reference_lookup_join(spark, sf_dir):
    """A vocabulary that is a table: nation codes resolved for suppliers, unknown codes pass through."""
    nation = table(spark, sf_dir, "nation").filter("n_regionkey != 4").select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("code"), "n_name")
    return standardize.lookup_join(entities.supplier_records(table(spark, sf_dir, "supplier")), "s_nation", nation, "code", "n_name")


@query
def standardized_report(spark, sf_dir):
    """The first standardized records by source and key, as a display would show them."""
    rows = contacts.silver(spark, sf_dir).select("source_id", "source_record_id", "source_updated_at", "full_name", "email", "phone", "city", "state",
                                                 "country", "date_of_birth")
    return rows.orderBy("source_id", "source_record_id", "source_updated_at").limit(30)


# ------------------------------------------------------------------ quality

@query
def dq_results(spark, sf_dir):
    return quality.results(contacts.checked(spark, sf_dir))


@query
def dq_status(spark, sf_dir):
    return contacts.checked(spark, sf_dir).select(
        "record_uid", "source_updated_at", "dq_status", F.size("dq_failures").cast("bigint").alias("n_failures"))


@query
def dq_metrics(spark, sf_dir):
    return quality.metrics(contacts.checked(spark, sf_dir), "source_id")


@query
def valid_quarantine_split(spark, sf_dir):
    checked = materialize(contacts.checked(spark, sf_dir), "checked")
    side = lambda df, name: df.select(F.lit(name).alias("side"), "record_uid", "source_updated_at")
    return side(quality.valid(checked), "valid").unionByName(side(quality.quarantine(checked), "quarantine"))


@query
def quarantine_reasons(spark, sf_dir):
    return quality.quarantine_reasons(contacts.checked(spark, sf_dir))


@query
def dq_orders(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")  # accounts in good standing
    checked = quality.evaluate(table(spark, sf_dir, "orders"), entities.ORDER_RULES, AS_OF, {"customer": customer})
    return quality.results(checked, "o_orderkey").select("o_orderkey", "rule_id", "severity")


@query
def dq_lineitem(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus != 'P'")
    checked = quality.evaluate(table(spark, sf_dir, "lineitem"), entities.LINE_RULES, AS_OF, {"orders": orders})
    return (quality.results(checked, "l_returnflag").groupBy("l_returnflag", "rule_id")
            .agg(F.count("*").alias("failures")))


@query
def dq_conversations(spark, sf_dir):
    checked = quality.evaluate(table(spark, sf_dir, "conversations"), entities.TURN_RULES, AS_OF)
    return quality.metrics(checked, "role")


# ------------------------------------------------------------------ identity resolution

@query
def block_keys(spark, sf_dir):
    return linkage.block_keys(valid(spark, sf_dir), MATCHING)


@query
def block_sizes(spark, sf_dir):
    return longs(linkage.block_sizes(valid(spark, sf_dir), MATCHING), "n_pairs")


@query
def oversize_blocks(spark, sf_dir):
    return longs(linkage.oversize_blocks(valid(spark, sf_dir), MATCHING, 20), "n_pairs")


@query
def candidate_pair_count(spark, sf_dir):
    return longs(linkage.candidate_pair_count(valid(spark, sf_dir), MATCHING), "candidate_pairs")


@query
def deterministic_links(spark, sf_dir):
    return linkage.deterministic_links(valid(spark, sf_dir), MATCHING)


@query
def pair_scores(spark, sf_dir):
    features = linkage.pair_features(valid(spark, sf_dir), MATCHING)
    sims = {f"sim_{f.attribute}": F.round(f"sim_{f.attribute}", 6) for f in MATCHING.features}
    return features.withColumns(sims).drop("method", "decision")


@query
def match_pairs(spark, sf_dir):
    return linkage.match_pairs(valid(spark, sf_dir), MATCHING)


@query
def match_bands(spark, sf_dir):
    return longs(linkage.match_bands(valid(spark, sf_dir), MATCHING), "record_pairs")


@query
def review_queue(spark, sf_dir):
    return linkage.review_queue(linkage.fuzzy_pairs(valid(spark, sf_dir), MATCHING), limit=10).select(
        "record_uid_1", "record_uid_2", "record_pairs", "score")


@query
def review_members(spark, sf_dir):
    """Whom the steward decides about: every record behind the pairs for review."""
    records = valid(spark, sf_dir)
    return linkage.review_members(linkage.fuzzy_pairs(records, MATCHING), linkage.profile_members(records, MATCHING))


@query
def profile_members(spark, sf_dir):
    return linkage.profile_members(valid(spark, sf_dir), MATCHING)


@query
def clusters(spark, sf_dir):
    return linkage.clusters(valid(spark, sf_dir), MATCHING)


@query
def cluster_conflicts(spark, sf_dir):
    """Some records of the old system come with another date of birth, but the e-mail of the same person."""
    other = F.regexp_extract("source_record_id", "^L([0-9]+)$", 1).try_cast("bigint") % 24 == 0
    raw = contacts.bronze(spark, sf_dir).withColumn("date_of_birth", F.when(other, "19770707").otherwise(F.col("date_of_birth")))
    checked = quality.evaluate(standardize.standardize(raw, CUSTOMER), CUSTOMER.rules, AS_OF)
    return linkage.cluster_conflicts(Mastering(checked, CUSTOMER, "b1", AS_OF).members, MATCHING)


# ------------------------------------------------------------------ golden records

@query
def survivorship_decisions(spark, sf_dir):
    return mastering(spark, sf_dir).decisions


@query
def golden(spark, sf_dir):
    return mastering(spark, sf_dir).golden.withColumn("mdm_created_ts", stamp("mdm_created_ts"))


@query
def crosswalk(spark, sf_dir):
    return mastering(spark, sf_dir).crosswalk


@query
def golden_metrics(spark, sf_dir):
    return longs(survivorship.golden_metrics(mastering(spark, sf_dir).crosswalk), "source_records_linked")


@query
def golden_report(spark, sf_dir):
    """The first golden records by name, as a display would show them."""
    rows = mastering(spark, sf_dir).golden.select("golden_id", "full_name", "email", "phone", "city", "state", "date_of_birth")
    return rows.orderBy("full_name", "golden_id").limit(30)


@query
def enrichment(spark, sf_dir):
    """Golden e-mail and city brought back to the customers of one source system."""
    work = mastering(spark, sf_dir)
    crm = contacts.customers(spark, sf_dir).select("c_custkey", "c_mktsegment", F.concat(F.lit("C"), F.col("c_custkey")).alias("cust_id"))
    return survivorship.enrich(crm, "cust_id", "CRM", work.crosswalk, work.golden, ["email", "city"]).select(
        "c_custkey", "c_mktsegment", "golden_id", "golden_email", "golden_city")


# ------------------------------------------------------------------ reconciliation and lineage

def _stages(spark: SparkSession, sf_dir: str, work: Mastering) -> dict[str, DataFrame]:
    return {"bronze": contacts.bronze(spark, sf_dir), "standardized": work.checked, "valid": work.valid,
            "quarantined": work.quarantine, "linked": work.crosswalk}


@query
def reconcile_counts(spark, sf_dir):
    return longs(reconcile.stage_counts(_stages(spark, sf_dir, mastering(spark, sf_dir))), *reconcile.STAGES)


@query
def reconcile_exceptions(spark, sf_dir):
    """The CRM extract lost its negative balances on the way and must be reported, the others balance."""
    work = mastering(spark, sf_dir)
    poor = contacts.customers(spark, sf_dir).filter("c_acctbal < 0").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("source_record_id"))
    broken = {**_stages(spark, sf_dir, work), "linked": work.crosswalk.join(poor, "source_record_id", "left_anti")}
    return longs(reconcile.exceptions(reconcile.stage_counts(broken)), "rows_before", "rows_after")


@query
def dedup_yield(spark, sf_dir):
    work = mastering(spark, sf_dir)
    result = reconcile.dedup_yield(reconcile.stage_counts(_stages(spark, sf_dir, work)), work.golden)
    return longs(result, *reconcile.STAGES, "golden_records", "dedup_consolidation")


def _entities(work: Mastering) -> DataFrame:
    return work.golden.select("golden_id")


@query
def lineage_members(spark, sf_dir):
    work = mastering(spark, sf_dir)
    return lineage.member_uids(work.crosswalk, _entities(work))


@query
def lineage_sources(spark, sf_dir):
    work = mastering(spark, sf_dir)
    return lineage.source_records(lineage.member_uids(work.crosswalk, _entities(work)), work.checked)


@query
def lineage_transforms(spark, sf_dir):
    work = mastering(spark, sf_dir)
    return lineage.transforms(lineage.member_uids(work.crosswalk, _entities(work)), work.checked)


@query
def lineage_dq(spark, sf_dir):
    """Annotations at a later date, when the old system's records have become stale."""
    work = Mastering(quality.evaluate(contacts.silver(spark, sf_dir), CUSTOMER.rules, "2027-08-01"), CUSTOMER, "b1", AS_OF)
    uids = lineage.member_uids(work.crosswalk, _entities(work))
    return lineage.dq_annotations(uids, quality.results(work.checked))


@query
def lineage_matches(spark, sf_dir):
    work = mastering(spark, sf_dir)
    stands = linkage.profile_members(work.valid, MATCHING)
    return lineage.match_decisions(lineage.member_uids(work.crosswalk, _entities(work)), work.pairs, stands)


@query
def lineage_survivorship(spark, sf_dir):
    work = mastering(spark, sf_dir)
    return lineage.survivorship(_entities(work), work.decisions)


@query
def lineage_trace(spark, sf_dir):
    """The whole evidence of every golden record, one JSON row per item."""
    work = mastering(spark, sf_dir)
    return work.trace(_entities(work))


@query
def lineage_documents(spark, sf_dir):
    """The same evidence as nested documents per golden record and section, each as its lines."""
    work = mastering(spark, sf_dir)
    nested = lineage.documents(work.trace(_entities(work)))
    return nested.withColumn("evidence", F.array_join("evidence", "\n"))


@query
def sample_entities(spark, sf_dir):
    return lineage.sample_entities(mastering(spark, sf_dir).crosswalk, 3, 5)


# ------------------------------------------------------------------ incremental

def _two_batches(spark: SparkSession, sf_dir: str):
    records = valid(spark, sf_dir)
    return records.filter("source_id != 'WEB'"), records.filter("source_id = 'WEB'")


@query
def incremental_match(spark, sf_dir):
    """Sign-ups matched against the entities of the other two systems; equals matching everything at once."""
    stored, incoming = _two_batches(spark, sf_dir)
    before = materialize(linkage.clusters(stored, MATCHING), "clusters")
    after = incremental.apply_increment(before, *incremental.match_increment(incoming, stored, before, MATCHING))
    return after.select("record_uid", linkage.cluster_name(F.col("root_uid")).alias("cluster_id"))


@query
def incremental_redirects(spark, sf_dir):
    stored, incoming = _two_batches(spark, sf_dir)
    before = materialize(linkage.clusters(stored, MATCHING), "clusters")
    return incremental.match_increment(incoming, stored, before, MATCHING)[1]


#: What the extracts of three batches hold: a condition on the customer key per source, and WEB's columns where it changed.
BATCHES = [
    ("20260801", {"CRM": "k % 7 != 3", "WEB": "true", "LEGACY": "true"}, {}),
    # LEGACY no longer has the customers that tie CRM and WEB records together; some sign-ups come with another address.
    ("20260802", {"CRM": "false", "WEB": "k % 8 = 0", "LEGACY": "k % 12 != 0"},
     {"contact_email": "concat('moved', k, '@example.com')", "mobile": "CAST(6000000000 + k AS STRING)", "modified_ts": "'2026-07-20'"}),
    # Half of them return to their first address, most of LEGACY is back with its old rows, and the missing CRM customers arrive.
    ("20260803", {"CRM": "k % 7 = 3", "WEB": "k % 16 = 0", "LEGACY": "k % 15 != 0"},
     {"modified_ts": "'2026-07-25'", "updated_at": "'2026-07-01'"}),
]


def _batches(spark: SparkSession, sf_dir: str) -> Mastering:
    """Three batches from landing files through the batch job, the later ones as increments of the entity store."""
    root = scratch_path(spark, "batches")
    layers = Layers(spark, f"{root}/tables")
    previous, work = None, None
    for batch, conditions, changed in BATCHES:
        sources = []
        for source in CUSTOMER.sources:
            key = next(c for c, canonical in source.field_map.items() if canonical == "source_record_id")
            extract = contacts.extract(contacts.customers(spark, sf_dir), source).withColumn(
                "k", F.regexp_extract(key, "([0-9]+)$", 1).cast("bigint"))
            rows = extract.filter(conditions[source.source_id])
            rows = rows.withColumns({c: F.expr(e) for c, e in changed.items() if c in rows.columns}).drop("k")
            folder = source.path.rsplit("/", 1)[0]
            rows.write.format(source.format).options(**source.options, header=True).save(f"{root}/{batch}/{folder}")
            sources.append(replace(source, path=f"{folder}/part-*"))
        spec = replace(CUSTOMER, sources=tuple(sources))
        work = run_batch(spark, spec, layers, f"{root}/{batch}", batch, AS_OF, previous)
        previous = batch
    return work


@query
def batch_entities(spark, sf_dir):
    """Entities after changes, returns, merges and removals in three batches; equals matching and surveying the last state."""
    work = _batches(spark, sf_dir)
    shown = work.golden.select("golden_id", *[F.col(a).alias(f"golden_{a}") for a in ATTRIBUTES])
    return work.crosswalk.select("golden_id", "record_uid", "source_id", "source_record_id").join(shown, "golden_id")


@query
def golden_upsert(spark, sf_dir):
    """Balances of all customers, then those of one segment corrected: only their buckets are rewritten."""
    rows = contacts.customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment", F.lit(1).alias("version"))
    path = scratch_path(spark, "upsert")
    incremental.write_buckets(rows, path, "c_custkey", 16)
    fixes = rows.filter("c_mktsegment = 'BUILDING'").withColumns({"c_acctbal": F.lit(0.0), "version": F.lit(2)})
    incremental.upsert_table(path, fixes, "c_custkey", "version", 16)
    return spark.read.parquet(path).drop("bucket")


@query
def golden_versions(spark, sf_dir):
    """Golden records over four batches: a correction, its return, removals, and a fold of the table in between."""
    made = mastering(spark, sf_dir).golden.select("golden_id", "full_name", "city", F.substring("golden_id", 3, 1).alias("first"))
    rows = materialize(made, "golden")
    kept = rows.select("golden_id", "full_name", "city")
    table_ = KeyedTable(spark, scratch_path(spark, "versions"))
    table_.start(kept, ["golden_id"], ["golden_id"], "b1", buckets=8)
    table_.change(kept.join(rows.filter("first < '4'").select("golden_id"), "golden_id").withColumn("city", F.lit("Corrected")), None, "b2")
    table_.change(kept.join(rows.filter("first < '2' OR first = 'a'").select("golden_id"), "golden_id"),
                  rows.filter("first = 'b'"), "b3")
    table_.maintain("b3", deltas=1)
    table_.change(kept.join(rows.filter("first = 'b'").select("golden_id"), "golden_id"), rows.filter("first = 'c'"), "b4")
    return table_.versions()


@query
def cdc_apply(spark, sf_dir):
    feed = entities.change_feed(table(spark, sf_dir, "events"))
    return incremental.apply_changes(feed, "user_id", ["ts", "event_id"], "op").select("user_id", "event_id", "op", "event_type", "value")


@query
def scd2_history(spark, sf_dir):
    rows = incremental.history(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "event_type")
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("valid_from", "valid_to")})


# ------------------------------------------------------------------ monitoring

@query
def metrics_quarantine_rate(spark, sf_dir):
    return monitor.quarantine_rates(contacts.checked(spark, sf_dir))


@query
def metrics_failures(spark, sf_dir):
    return monitor.failures_by_source_and_rule(contacts.checked(spark, sf_dir))


@query
def metrics_review_depth(spark, sf_dir):
    return longs(monitor.review_depth(linkage.fuzzy_pairs(valid(spark, sf_dir), MATCHING)), "record_pairs")


@query
def metrics_batch_latency(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("batch", F.date_format("ts", "yyyy-MM-dd"))
    return monitor.batch_latency(days, "batch", "ts").select("batch", "n_events", "seconds")


def _error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return (events.groupBy(F.lit("errors").alias("series"), F.date_format("ts", "yyyy-MM-dd").alias("batch"))
            .agg(F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 6).alias("rate")))


@query
def alerts_rate_spike(spark, sf_dir):
    spikes = monitor.rate_spikes(_error_rates(spark, sf_dir), "series", "batch", "rate", trailing=7, sigmas=1.0)
    return spikes.withColumns({c: F.round(c, 6) for c in ("baseline", "deviation")})


@query
def alerts_stalled_sources(spark, sf_dir):
    marks = ingest.high_water_marks(contacts.bronze(spark, sf_dir), CUSTOMER)
    return (monitor.stalled_sources(marks, AS_OF, 30).withColumn("high_water_mark", stamp("high_water_mark"))
            .withColumn("days_behind", F.col("days_behind").cast("bigint")))


@query
def alerts_review_sla(spark, sf_dir):
    records = valid(spark, sf_dir)
    late = monitor.review_sla_breaches(linkage.fuzzy_pairs(records, MATCHING), records, AS_OF, 14,
                                       linkage.profile_members(records, MATCHING))
    return longs(late, "days_waiting", "late_pairs")


@query
def alerts_summary(spark, sf_dir):
    work = mastering(spark, sf_dir)
    marks = ingest.high_water_marks(work.checked, CUSTOMER)
    return monitor.alerts({
        "reconciliation_exception": reconcile.exceptions(reconcile.stage_counts(_stages(spark, sf_dir, work))),
        "rate_spike": monitor.rate_spikes(_error_rates(spark, sf_dir), "series", "batch", "rate", 7, 1.0),
        "watermark_stall": monitor.stalled_sources(marks, AS_OF, 30),
        "review_sla": monitor.review_sla_breaches(work.pairs, work.valid, AS_OF, 14,
                                                  linkage.profile_members(work.valid, MATCHING)),
    })


# ------------------------------------------------------------------ privacy

def _subjects(spark: SparkSession, sf_dir: str, work: Mastering) -> DataFrame:
    """Customers with an overdrawn account asked for their data."""
    asking = contacts.customers(spark, sf_dir).filter("c_acctbal < 0").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("source_record_id"))
    return work.crosswalk.filter("source_id = 'CRM'").join(asking, "source_record_id").select("golden_id")


@query
def sar_export(spark, sf_dir):
    work = mastering(spark, sf_dir)
    return privacy.export_subjects(_subjects(spark, sf_dir, work), work.crosswalk, work.checked)


@query
def evidence_on_request(spark, sf_dir):
    """All that was compared for the entities that asked: why their records belong together, and whom they were kept from."""
    work = mastering(spark, sf_dir)
    owned = privacy.subject_members(_subjects(spark, sf_dir, work), work.crosswalk)
    return linkage.compared_pairs(work.valid, owned, MATCHING)


@query
def erasure(spark, sf_dir):
    work = mastering(spark, sf_dir)
    kept = privacy.erase_subjects(work.valid, _subjects(spark, sf_dir, work), work.crosswalk)
    return kept.select("record_uid", "source_id", "source_record_id")


@query
def erasure_layers(spark, sf_dir):
    """What every layer still holds after an erasure through the subject index: checked rows, dead letters, crosswalk, golden records."""
    work, layers = mastering(spark, sf_dir), Layers(spark, scratch_path(spark, "erasure"))
    torn = contacts.customers(spark, sf_dir).filter("c_mktsegment = 'BUILDING'").select(
        F.lit("CRM").alias("source_id"), F.concat(F.lit("C"), "c_custkey", F.lit(";"), "c_name").alias("payload"), F.lit("torn").alias("reason"))
    layers.write(torn, "bronze", "dead_letters", "b1")
    layers.write(work.checked, "silver", "customer_checked", "b1")
    layers.write(work.crosswalk, "gold", "crosswalk", "b1")
    layers.write(work.golden, "gold", "golden_customer", "b1")
    index = SubjectIndex(layers, CUSTOMER)
    index.index_batch("b1")
    crosswalk = materialize(work.crosswalk, "crosswalk")
    index.erase(_subjects(spark, sf_dir, work), crosswalk, "b2")
    shown = [("bronze", "dead_letters", "payload"), ("silver", "customer_checked", "record_uid"), ("gold", "crosswalk", "record_uid"),
             ("gold", "golden_customer", "golden_id")]
    return reduce(DataFrame.unionByName, [
        layers.read(layer, name).select(F.lit(name).alias("name"), F.col(column).alias("held")) for layer, name, column in shown])


@query
def masking(spark, sf_dir):
    policy = {"full_name": "characters", "email": "email", "phone": "last4", "date_of_birth": "year",
              "address_line": "null", "record_uid": "hash"}
    return privacy.mask_columns(contacts.silver(spark, sf_dir).select(
        "record_uid", "source_updated_at", "full_name", "email", "phone", "address_line", "date_of_birth", "city"), policy)


# ------------------------------------------------------------------ thresholds and learning

#: The steward's and the scorer's pairs, and the steps of the curve, start here; its last row counts all pairs below as one band.
LEAST_SCORE = 0.45


def _person() -> Column:
    """The customer behind a record, empty for namesakes."""
    return F.regexp_extract("source_record_id", "^[CUL]([0-9]+)$", 1)


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records with the truth: the customer they come from, none for namesakes."""
    return valid(spark, sf_dir).withColumn("person", F.nullif(_person(), F.lit("")))


@query
def pr_curve(spark, sf_dir):
    """Recall against all true pairs that no key decides.  The row at 0 is everything compared: pairs below the listed scores
    are counted from group sizes, so what it adds to the row above are the true pairs that no listed threshold finds."""
    people = _people(spark, sf_dir)
    total = evaluate.open_true_pairs(people, "person", MATCHING)
    counted = linkage.score_counts(people, MATCHING, LEAST_SCORE, "person").withColumnRenamed("is_same", "is_match")
    curve = evaluate.precision_recall(counted, weight="record_pairs", total=total)
    tagged = [counted.select(F.lit(tag).alias("tag"), counted.columns[0]).toDF("tag", "n") for tag, counted in (
        ("merged", linkage.open_pair_count(people, MATCHING)), ("true", linkage.open_pair_count(people, MATCHING, "person")), ("all", total))]
    count = lambda tag: F.max(F.when(F.col("tag") == tag, F.col("n")))
    whole = reduce(DataFrame.unionByName, tagged).agg(count("merged").alias("merged"), count("true").alias("true_merged"), count("all").alias("total"))
    last = whole.filter("merged > 0").select(
        F.lit(0.0).alias("threshold"), "merged", "true_merged", F.round(F.col("true_merged") / F.col("merged"), 6).alias("precision"),
        F.round(F.try_divide("true_merged", "total"), 6).alias("recall"))
    return longs(curve, "merged", "true_merged").unionByName(last)


@query
def ml_scorer(spark, sf_dir):
    """A learned scorer on four fifths of the steward decisions (by hash of the pair), applied to all; `held_out` is the rest.

    The pairs are formed twice, counted by their similarities for the fit and listed for the result, and stored in neither case."""
    people = _people(spark, sf_dir)
    fifth = (5, 0)
    counted = linkage.feature_counts(people, MATCHING, LEAST_SCORE, "person", fifth).withColumnRenamed("is_same", "is_match")
    model = evaluate.train_scorer(counted, MATCHING, weight="pairs")
    held_out = F.pmod(F.xxhash64("record_uid_1", "record_uid_2"), F.lit(fifth[0])) == fifth[1]
    pairs = linkage.pair_features(people, MATCHING, LEAST_SCORE, same="person").withColumnRenamed("is_same", "is_match")
    return evaluate.apply_scorer(model, pairs).select("record_uid_1", "record_uid_2", "score", "is_match", held_out.alias("held_out"),
                                                      "match_probability")


@query
def label_threshold_curve(spark, sf_dir):
    """Threshold curve on the labelled documents: share of letters as the score."""
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]", "")) / F.greatest(F.length("text"), F.lit(1))
    scored = table(spark, sf_dir, "documents").select("doc_id", F.round(letters, 2).alias("score"))
    labelled = scored.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("is_match", F.col("quality") == 1)
    return longs(evaluate.precision_recall(labelled), "merged", "true_merged")


# ------------------------------------------------------------------ other entities

def _parts(spark: SparkSession, sf_dir: str) -> Mastering:
    records = standardize.standardize(entities.part_records(table(spark, sf_dir, "part")), entities.PART)
    return Mastering(quality.evaluate(records, entities.PART.rules, AS_OF), entities.PART, "b1", AS_OF)


@query
def part_match_pairs(spark, sf_dir):
    return _parts(spark, sf_dir).pairs


@query
def part_match_bands(spark, sf_dir):
    return longs(linkage.match_bands(_parts(spark, sf_dir).valid, entities.PART.matching), "record_pairs")


@query
def part_clusters(spark, sf_dir):
    return _parts(spark, sf_dir).clusters


@query
def part_golden(spark, sf_dir):
    return _parts(spark, sf_dir).golden.drop("mdm_created_ts")


@query
def document_clusters(spark, sf_dir):
    records = standardize.standardize(entities.document_records(table(spark, sf_dir, "documents")), entities.DOCUMENT)
    return linkage.clusters(records, entities.DOCUMENT.matching)


@query
def document_survivors(spark, sf_dir):
    """Which copy of a text survives, by rank of its source."""
    raw = entities.document_records(table(spark, sf_dir, "documents"))
    records = standardize.standardize(raw, entities.DOCUMENT)
    work = Mastering(quality.evaluate(records, [], AS_OF), entities.DOCUMENT, "b1", AS_OF)
    return work.decisions.filter("attribute = 'text'").select(
        "cluster_id", "winning_record_uid", "winning_source", F.sha2("golden_value", 256).alias("text_sha"))


# ------------------------------------------------------------------ streaming

def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query
def stream_ingest(spark, sf_dir):
    """The WEB extract streamed to bronze with the batch field map, read back."""
    root = scratch_path(spark, "stream")
    source = CUSTOMER.source("WEB")
    extract = contacts.extract(_stream(spark, sf_dir, "customer"), source)
    micro_batch.land(extract, source, CUSTOMER, f"{root}/bronze", f"{root}/checkpoint", AS_OF).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").drop("ingest_ts", "raw_payload")


@query
def stream_quality(spark, sf_dir):
    """All sources standardized and checked per micro-batch."""
    root = scratch_path(spark, "stream")
    layers = Layers(spark, root)
    stream = contacts.landed(_stream(spark, sf_dir, "customer"))
    micro_batch.check(stream, CUSTOMER, layers, f"{root}/checkpoint", AS_OF).awaitTermination()
    checked = layers.read("silver", "customer_checked")
    return checked.groupBy("source_id", "dq_status").agg(F.count("*").alias("n_rows"))


@query
def stream_unique(spark, sf_dir):
    """Records of one source per epoch, an e-mail address unique across the epochs: who repeats one."""
    root = scratch_path(spark, "stream")
    layers, landed = Layers(spark, root), contacts.landed(table(spark, sf_dir, "customer"))
    rule = {"rule_id": "E1", "rule_type": "unique", "columns": ["email"], "severity": "WARN", "description": "e-mail used once"}
    for source in ("CRM", "LEGACY", "WEB"):
        landed.filter(F.col("source_id") == source).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(landed.schema).parquet(f"{root}/in")
        micro_batch.check(stream, CUSTOMER, layers, f"{root}/checkpoint", AS_OF, [rule]).awaitTermination()
    repeated = F.exists("dq_failures", lambda f: f["rule_id"] == "E1")
    return layers.read("silver", "customer_checked").select("record_uid", "source_id", repeated.alias("email_repeated"))


@query
def stream_match(spark, sf_dir):
    """Valid records replayed as a stream, a few files per micro-batch, matched against the store."""
    root = scratch_path(spark, "stream")
    layers = Layers(spark, root)
    records = valid(spark, sf_dir)
    columns = ["record_uid", "source_id", "source_record_id", *ATTRIBUTES]
    for source in ("CRM", "LEGACY", "WEB"):
        records.filter(F.col("source_id") == source).select(*columns).write.mode("append").parquet(f"{root}/in")
    stream = (spark.readStream.schema(records.select(*columns).schema).option("maxFilesPerTrigger", 8)
              .parquet(f"{root}/in"))
    micro_batch.match(stream, CUSTOMER, layers, f"{root}/checkpoint").awaitTermination()
    state = layers.read("gold", "entity_clusters")
    last = state.agg(F.max("batch_id").alias("batch_id"))
    return state.join(last, "batch_id").select("record_uid", "cluster_id")


@query
def stream_dedup(spark, sf_dir):
    """Events with their first occurrence per key kept by a watermarked streaming deduplication."""
    root = scratch_path(spark, "stream")
    twice = _stream(spark, sf_dir, "events").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    stream = micro_batch.distinct_within(twice.withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts", "1 hour")
    (stream.drop("copy").writeStream.format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "event_type", "value")
