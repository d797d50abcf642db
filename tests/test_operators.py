"""Edge cases of the single operators: nulls, duplicates, empty input, ties, malformed values."""

import json
import time

import pytest
from pyspark.sql import functions as F

from kinfold import session
from kinfold.functions import similarity as sim
from kinfold.functions.transforms import apply_chain
from kinfold.operators import (evaluate, incremental, ingest, lineage, linkage, monitor, privacy, quality, reconcile, standardize,
                               survivorship)
from kinfold.plans.customer import CUSTOMER, RAW_SPEC, STANDARDIZATION
from kinfold.sources import files
from kinfold.sources.tables import Layers, check_batch_id
from kinfold.spec import EntitySpec, Matching, Source, SpecError, load_spec
from test_linkage import indel, lcs, token_set, token_sort


def one(spark, chain, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(apply_chain(F.col("v"), chain)).collect()]


# ---------------------------------------------------------------- transforms

@pytest.mark.parametrize("attribute, cases", {
    "full_name": {" rahul  SHARMA ": "Rahul Sharma", "Mr. ann lee": "Ann Lee", "Mr Dr Foo": "Dr Foo", "Drake Bell": "Drake Bell",
                  "mary-ann o'neil": "Mary-ann O'neil", "Mr.": "Mr.", "": "", "a\tb": "A B"},
    "email": {" A.B@X.COM ": "a.b@x.com", "a[at]x.com": None, "a@x": None, "": None},
    "phone": {"+91-98765-43210": "9876543210", "09876543210": "9876543210", "9876543210": "9876543210",
              "019876543210": "019876543210", "none": None, "": None, "919876543": "919876543"},
    "address_line": {"12 mg rd": "12 Mg Road", "4 PALM ST.": "4 Palm Street", "1 Stone st": "1 Stone Street", "Apt 3 Blk 4": "Apartment 3 Block 4"},
    "city": {" GURGAON": "Gurugram", "bombay ": "Mumbai", "Pune": "Pune"},
    "state": {"uttar pradesh": "UP", "Telangana": "TELANGANA"},
    "country": {"india": "IN", "Ind": "IN", "us": "US"},
    "date_of_birth": {"1990-04-12": "1990-04-12", "12/04/1990": "1990-04-12", "04/07/1993": "1993-07-04", "12/31/1993": "1993-12-31",
                      "19900412": "1990-04-12", "12-04-1990": "1990-04-12", "12-Apr-1990": "1990-04-12", "31/02/1990": None, "soon": None},
}.items())
def test_chains(spark, attribute, cases):
    assert one(spark, STANDARDIZATION[attribute], *cases, None) == [*cases.values(), None]


def test_abbreviations_are_literal_text(spark):
    chain = [{"transform": "expand_abbreviations", "params": {"map": {"a.b": "x$1"}}}]
    assert one(spark, chain, "a.b", "acb") == ["x$1", "acb"]


def test_log_keeps_before_and_after(spark):
    spec = EntitySpec.parse({"entity": "e", "attributes": ["a", "b", "gone"], "standardization": {
        "a": [{"transform": "trim"}, {"transform": "upper_case"}], "b": [{"transform": "lower_case"}], "gone": [{"transform": "trim"}]}})
    df = spark.createDataFrame([(1, " x ", "y"), (2, None, "Y")], "id int, a string, b string")
    done = standardize.standardize(df, spec)
    assert done.columns == ["id", "a", "b", "transform_log"]
    assert {tuple(r) for r in standardize.changed_values(done, "id").collect()} == {
        (1, "a", " x ", "X", "trim|upper_case"), (2, "b", "Y", "y", "lower_case")}
    assert standardize.log_entries(done, "id").count() == 4


def test_lookup_join_cannot_multiply_rows(spark):
    df = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "v string")
    ref = spark.createDataFrame([("A", "2"), ("a", "1"), ("b", "3")], "k string, w string")
    rows = standardize.lookup_join(df, "v", ref, "k", "w").collect()
    assert len(rows) == 4 and {r["v"] for r in rows} == {"1", "3", "c", None}


# ---------------------------------------------------------------- similarity

def test_similarity_kernels(spark):
    texts = ["", "a", "rohit sharma", "sharma rohit", "5 Mg Road", "17 Mall Road", "rohit", "x" * 300, "x" * 150 + "y" * 150,
             "naïve café", "a a b", "a b", "12 12 12", "安娜 李"]
    pairs = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.withColumns({"sa": sim.sorted_tokens("a"), "sb": sim.sorted_tokens("b"), "ta": sim.distinct_tokens("a"),
                         "tb": sim.distinct_tokens("b")})
    sa, sb = F.col("sa"), F.col("sb")
    rows = df.select("a", "b", sim.make_kernel("lcs")("a", "b").alias("l"), sim.ratio("token_sort_ratio", sa, sb).alias("s"),
                     sim.ratio("token_set_ratio", F.col("ta"), F.col("tb")).alias("t"), sim.sort_ratio_bound(sa, sb).alias("bound")).collect()
    for r in rows:
        assert r["l"] == lcs(r["a"], r["b"])
        assert r["s"] == pytest.approx(token_sort(r["a"], r["b"]))
        assert r["t"] == pytest.approx(token_set(r["a"], r["b"]))
        assert r["bound"] >= r["s"] - 1e-12
    assert indel("", "") == 1.0


# ---------------------------------------------------------------- quality

RULES = [
    {"rule_id": "U", "rule_type": "unique", "columns": ["k"], "severity": "ERROR", "description": "unique"},
    {"rule_id": "R", "rule_type": "reference", "column": "k", "reference": "known", "reference_column": "id", "severity": "WARN",
     "description": "known", "allow_null": True},
    {"rule_id": "D", "rule_type": "domain", "column": "v", "allowed_values": ["x"], "severity": "WARN", "description": "domain"},
    {"rule_id": "E", "rule_type": "expression", "expression": "d < {as_of}", "severity": "ERROR", "description": "before"},
]


def test_rules_nulls_copies_and_order(spark):
    df = spark.createDataFrame([(1, "x", "2020-01-01"), (1, "x", "2020-01-01"), (2, None, "2020-01-01"), (None, "x", "2020-01-01"),
                                (None, "y", "2020-01-01"), (3, "x", None), (4, "x", "2030-01-01")], "k int, v string, d string") \
        .withColumn("d", F.to_date("d"))
    known = spark.createDataFrame([(1,), (1,), (3,), (4,)], "id int")
    done = quality.evaluate(df, RULES, "2026-08-01", {"known": known})
    assert done.count() == 7  # neither the repeated reference key nor the repeated row key multiplies
    got = sorted((str(r["k"]), str(r["v"]), [f["rule_id"] for f in r["dq_failures"]], r["dq_status"]) for r in done.collect())
    assert got == [("1", "x", ["U"], "QUARANTINED"), ("1", "x", ["U"], "QUARANTINED"),
                   ("2", "None", ["R", "D"], "VALID_WITH_WARNINGS"), ("3", "x", ["E"], "QUARANTINED"),
                   ("4", "x", ["E"], "QUARANTINED"), ("None", "x", ["U"], "QUARANTINED"), ("None", "y", ["U", "D"], "QUARANTINED")]
    assert quality.valid(done).count() + quality.quarantine(done).count() == 7
    assert quality.metrics(done).first().asDict() == {"rows_in": 7, "rows_valid": 1, "rows_quarantined": 6, "rule_failures": 9}


def test_warnings_depend_on_the_pinned_date(spark):
    base = {"full_name": "A", "email": None, "phone": "123", "country": "FR", "date_of_birth": "1990-01-01", "batch_id": "b",
            "source_id": "LEGACY", "source_record_id": "1", "source_updated_at": "2024-01-20"}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))
    rules = lambda day: [f["rule_id"] for f in quality.evaluate(df, CUSTOMER.rules, day).first()["dq_failures"]]
    assert rules("2026-08-01") == ["DQ004", "DQ005"]
    assert rules("2027-01-20") == ["DQ004", "DQ005"]
    assert rules("2027-01-21") == ["DQ004", "DQ005", "DQ008"]


def test_empty_quality_input(spark):
    df = spark.createDataFrame([], "k int, v string, d date")
    done = quality.evaluate(df, RULES[:1] + RULES[2:], "2026-08-01")
    assert quality.metrics(done).first().asDict() == {"rows_in": 0, "rows_valid": 0, "rows_quarantined": 0, "rule_failures": 0}


# ---------------------------------------------------------------- survivorship

def test_survivorship_orders_and_ties(spark):
    spec = EntitySpec.parse({"entity": "e", "attributes": ["a", "b", "c", "d", "none"], "survivorship": {
        "a": ["source_precedence", "most_recent"], "b": ["most_recent", "source_precedence"], "c": ["non_null_longest"]}})
    rows = [("c1", "u3", "S1", 1, "2026-01-01", "old", "b1", "xx", "d3", None),
            ("c1", "u2", "S1", 1, "2026-02-01", "new", None, "yyy", "d2", None),
            ("c1", "u1", "S2", 2, "2026-03-01", "web", "b2", "zzz", None, None),
            ("c1", "u0", "S3", None, "not a date", None, "b3", None, "d0", None),
            ("c2", "u9", "S3", None, None, "only", None, None, None, None)]
    df = spark.createDataFrame(rows, "cluster_id string, record_uid string, source_id string, trust_rank int, "
                                     "source_updated_at string, a string, b string, c string, d string, none string")
    won = survivorship.winners(df, spec)
    got = {(r["cluster_id"], r["attribute"]): (r["golden_value"], r["winning_record_uid"]) for r in survivorship.decisions(won, spec).collect()}
    assert got == {("c1", "a"): ("new", "u2"), ("c1", "b"): ("b2", "u1"), ("c1", "c"): ("zzz", "u1"), ("c1", "d"): ("d0", "u0"),
                   ("c2", "a"): ("only", "u9")}
    golden = {r["golden_id"]: r for r in survivorship.golden(won, spec, "b", "2026-08-01").collect()}
    assert golden["c1"]["none"] is None and golden["c2"]["a"] == "only"


# ---------------------------------------------------------------- landing

def source(**changes):
    raw = {"source_id": "S", "format": "csv", "path": "in/*.csv", "field_map": {"id": "source_record_id", "n": "full_name"}}
    return Source.parse({**raw, **changes})


def test_corrupt_lines_and_missing_keys_are_parked(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,n\n1,Ann\n2\n3,Bob,extra\n,NoKey\n")
    (tmp_path / "in" / "b.csv").write_text("id,n\n4,Dan\n")
    df = files.scan(spark, source(), str(tmp_path))
    good, dead = files.split_dead_letters(df, source())
    assert {tuple(r) for r in good.collect()} == {("1", "Ann"), ("4", "Dan")}
    assert {(r["payload"], r["reason"]) for r in dead.collect()} == {
        ("2", "corrupt_record"), ("3,Bob,extra", "corrupt_record"), ('{"id":null,"n":"NoKey"}', "missing_key")}


def test_json_extra_fields_stay_in_the_payload(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": "1", "n": "Ann", "vip": true}\n{"id": "2"}\n{broken\n')
    src = source(format="json", path="in/*.json")
    good, dead = files.split_dead_letters(files.scan(spark, src, str(tmp_path)), src)
    rows = ingest.to_canonical(good, src, EntitySpec.parse({"entity": "e", "attributes": ["full_name", "email"]}), "b", "2026-08-01").collect()
    payload = {r["source_record_id"]: json.loads(r["raw_payload"]) for r in rows}
    assert payload == {"1": {"id": "1", "n": "Ann", "vip": "true"}, "2": {"id": "2", "n": None, "vip": None}}
    assert {r["email"] for r in rows} == {None}
    assert [(r["payload"], r["reason"]) for r in dead.collect()] == [("{broken", "corrupt_record")]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_sources(spark, tmp_path, fmt):
    spark.createDataFrame([("1", "Ann")], "id string, n string").write.format(fmt).save(str(tmp_path / "in"))
    src = source(format=fmt, path="in")
    good, dead = files.split_dead_letters(files.scan(spark, src, str(tmp_path)), src)
    assert (good.count(), dead.count()) == (1, 0)


def test_layout_drift(spark):
    df = spark.createDataFrame([("1", "x")], "id string, other string")
    assert files.check_layout(df, source()) == ["missing n", "unexpected other"]
    with pytest.raises(SpecError, match="missing n"):
        files.check_layout(df, source(schema_evolution="strict"))


def test_published_uid(spark):
    df = spark.range(1).select(ingest.record_uid(F.lit("CRM"), F.lit("C003")).alias("u"))
    assert df.first()["u"].startswith("72a37b16da9feb3e50d1fc")


def test_unmapped_column_with_a_canonical_name_does_not_leak(spark):
    df = spark.createDataFrame([("1", "Ann", "leak@x.io")], "id string, n string, email string")
    row = ingest.to_canonical(df, source(), EntitySpec.parse({"entity": "e", "attributes": ["full_name", "email"]}), "b", "2026-08-01").first()
    assert row["email"] is None and "leak" in row["raw_payload"]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None), ("5", "x"), ("5", "x")], "k string, v string")
    new = spark.createDataFrame([("1", "a"), ("2", "B"), ("3", None), ("4", "n"), ("5", "x")], "k string, v string")
    got = {tuple(r) for r in ingest.snapshot_diff(old, new, "k", ["k", "v"]).collect()}
    assert got == {("1", "unchanged"), ("2", "update"), ("3", "unchanged"), ("4", "insert"), ("5", "update")}
    assert {r["change"] for r in ingest.snapshot_diff(old.limit(1), new.filter("false"), "k", ["k", "v"]).collect()} == {"delete"}


def test_layers_replace_only_their_batches(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    rows = lambda b, *v: spark.createDataFrame([(b, x) for x in v], "batch_id string, v int")
    layers.write(rows("20260801", 1, 2), "bronze", "t")
    layers.write(rows("20260802", 3), "bronze", "t")
    layers.write(rows("20260802", 4, 5), "bronze", "t")
    assert sorted((r["batch_id"], r["v"]) for r in layers.read("bronze", "t").collect()) == [
        ("20260801", 1), ("20260801", 2), ("20260802", 4), ("20260802", 5)]
    assert layers.read("bronze", "t", "20260801").count() == 2
    with pytest.raises(ValueError):
        layers.path("tin", "t")


def test_layers_survive_odd_batches(spark, tmp_path):
    """Ids with leading zeros, a replay to nothing, a first write without rows, a column that comes later."""
    layers = Layers(spark, str(tmp_path))
    empty = spark.createDataFrame([], "v int")
    layers.write(empty, "ops", "none", "007")
    assert layers.read("ops", "none").count() == 0 and layers.read("ops", "none", "007").columns == ["v", "batch_id"]
    layers.write(spark.createDataFrame([(1,)], "v int"), "bronze", "t", "007")
    layers.write(spark.createDataFrame([(2,)], "v int"), "bronze", "t", "010")
    layers.write(empty, "bronze", "t", "010")
    layers.write(spark.createDataFrame([(3, "x")], "v int, w string"), "bronze", "t", "011")
    assert [tuple(r) for r in layers.read("bronze", "t", "007").select("batch_id", "v", "w").collect()] == [("007", 1, None)]
    assert sorted((r["batch_id"], r["v"], r["w"]) for r in layers.read("bronze", "t").collect()) == [("007", 1, None), ("011", 3, "x")]
    for one in ("a/b", "", "x=1"):
        with pytest.raises(SpecError):
            check_batch_id(one)
    with pytest.raises(SpecError):
        check_batch_id("10", "9")


def test_record_that_returns_to_an_earlier_payload_is_new(spark):
    spec = EntitySpec.parse({"entity": "e", "attributes": ["full_name"], "sources": [
        {"source_id": "S", "format": "csv", "path": "x", "field_map": {"id": "source_record_id"}}]})
    columns = "record_uid string, source_id string, source_updated_at string, raw_payload string, batch_id string"
    landed = spark.createDataFrame([("u", "S", "2026-01-01", "A", "b1"), ("u", "S", "2026-01-02", "B", "b2")], columns)
    marks = spark.createDataFrame([], "source_id string, high_water_mark timestamp")
    again = lambda p: spark.createDataFrame([("u", "S", "2026-01-03", p, "b3")], columns)
    assert ingest.filter_incremental(again("A"), marks, spec, landed).count() == 1
    assert ingest.filter_incremental(again("B"), marks, spec, landed).count() == 0


def test_merging_csv_reads_each_file_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Ann\n2,Bob\n")
    (tmp_path / "b.csv").write_text('extra,id,name\n"x,y",3,Cid\n')
    (tmp_path / "c.csv").write_text("id\n4\n")
    raw = {"source_id": "S", "format": "csv", "path": "*.csv", "field_map": {"id": "source_record_id", "name": "full_name"}}
    got = files.scan(spark, Source.parse(raw), str(tmp_path))
    assert got.columns == ["id", "name", "extra", files.CORRUPT]
    assert sorted(tuple(r)[:3] for r in got.collect()) == [
        ("1", "Ann", None), ("2", "Bob", None), ("3", "Cid", "x,y"), ("4", None, None)]


def test_contract_parks_rows_before_landing(spark):
    extract = spark.createDataFrame([("1", "a@x"), ("2", None)], "id string, mail string")
    rules = [{"rule_id": "C1", "rule_type": "not_null", "column": "mail", "severity": "ERROR", "description": "d"}]
    kept, parked = quality.split_contract(extract, rules, "2026-08-01")
    assert [tuple(r) for r in kept.collect()] == [("1", "a@x")]
    assert [tuple(r) for r in parked.collect()] == [('{"id":"2","mail":null}', "contract:C1")]


# ---------------------------------------------------------------- copies of a profile

def test_copies_keep_their_decisions_and_their_age(spark):
    """Three equal records and a near copy: every one of the copies shows its review decisions, the oldest pair counts."""
    matching = Matching.parse({
        "blocking": [{"name": "b", "expr": "country", "columns": ["country"]}], "deterministic": [["email"]],
        "features": [{"attribute": "full_name", "method": "token_sort_ratio", "weight": 1.0}],
        "thresholds": {"auto_match": 1.5, "review": 0.8}})
    rows = [("a", "ann lee smith", "2026-07-31"), ("b", "ann lee smith", "2026-06-01"), ("c", "ann lee smith", "2026-06-02"),
            ("d", "ann lee smyth", "2026-07-31"), ("e", "zoe", "2026-01-01")]
    records = spark.createDataFrame([(u, n, "IN", None, d) for u, n, d in rows],
                                    "record_uid string, full_name string, country string, email string, source_updated_at string")
    pairs, stands = linkage.match_pairs(records, matching), linkage.profile_members(records, matching)
    each = records.select(F.concat(F.lit("E-"), "record_uid").alias("golden_id"), "record_uid")
    seen = lineage.match_decisions(each, pairs, stands).groupBy("golden_id").agg(F.sum("record_pairs").alias("n")).collect()
    assert {r["golden_id"]: r["n"] for r in seen} == {"E-a": 6, "E-b": 6, "E-c": 6, "E-d": 3}
    late = monitor.review_sla_breaches(pairs, records, "2026-08-01", 14, stands).collect()
    assert [(r["record_uid_1"], r["record_uid_2"], r["late_pairs"], r["days_waiting"]) for r in late] == [("a", "c", 1, 60)]
    older = records.withColumn("source_updated_at", F.when(F.col("record_uid") == "d", None).otherwise(F.col("source_updated_at")))
    late = {(r["record_uid_1"], r["record_uid_2"]): (r["late_pairs"], r["days_waiting"])
            for r in monitor.review_sla_breaches(pairs, older, "2026-08-01", 14, stands).collect()}
    assert late == {("a", "c"): (1, 60), ("a", "d"): (2, 61)}


# ---------------------------------------------------------------- specs

def test_specs_reject_what_no_operator_reads(tmp_path):
    for change in ({"sources": [{**RAW_SPEC["sources"][0], "watermark_column": "x"}]},
                   {"sources": [{**RAW_SPEC["sources"][0], "format": "xml"}]},
                   {"standardization": {"email": [{"transform": "nope"}]}},
                   {"rules": [{"rule_id": "X", "rule_type": "regex", "column": "a", "severity": "ERROR", "description": ""}]},
                   {"rules": [{"rule_id": "X", "rule_type": "not_null", "column": "a", "severity": "FATAL", "description": ""}]},
                   {"survivorship": {"email": ["coin_toss"]}}, {"reject_if": []}):
        with pytest.raises(SpecError):
            EntitySpec.parse({**RAW_SPEC, **change})
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        source(format="xml")


def test_spec_round_trips_through_yaml(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "customer.yaml").write_text(yaml.safe_dump(RAW_SPEC, allow_unicode=True))
    loaded = load_spec(tmp_path / "customer.yaml")
    assert loaded.matching == CUSTOMER.matching and loaded.version == CUSTOMER.version
    changed = EntitySpec.parse({**RAW_SPEC, "default_strategy": ["most_recent"]})
    assert changed.version != CUSTOMER.version


# ---------------------------------------------------------------- changes and history

def test_apply_changes_and_upsert(spark):
    feed = spark.createDataFrame([(1, 1, "I", "a"), (1, 3, "U", "c"), (1, 2, "U", "b"), (2, 1, "I", "x"), (2, 2, "D", None),
                                  (3, 1, "D", None), (3, 2, "I", "back")], "k int, seq int, op string, v string")
    assert {(r["k"], r["v"]) for r in incremental.apply_changes(feed, "k", ["seq"], "op").collect()} == {(1, "c"), (3, "back")}
    base = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, version int, v string")
    late = spark.createDataFrame([(1, 2, "A"), (2, 4, "old"), (3, 1, "n")], "k int, version int, v string")
    assert {(r["k"], r["v"]) for r in incremental.upsert(base, late, "k", "version").collect()} == {(1, "A"), (2, "b"), (3, "n")}


def test_history_is_the_same_for_any_chunk(spark):
    rows = [(1, f"2026-01-{d:02d} {h:02d}:00:00", d * 100 + h, v) for d, h, v in
            [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (2, 1, "b"), (3, 1, "b"), (3, 2, None), (4, 1, None), (4, 2, "a"), (9, 1, "c")]]
    df = spark.createDataFrame(rows, "k int, t string, id int, v string").withColumn("t", F.to_timestamp("t"))
    want = [("a", "01 01", "01 03"), ("b", "01 03", "03 02"), (None, "03 02", "04 02"), ("a", "04 02", "09 01"), ("c", "09 01", None)]
    for chunk in ("hour", "day", "month"):
        got = incremental.history(df, "k", "t", "id", "v", chunk).orderBy("valid_from").collect()
        assert [(r["v"], f"{r['valid_from']:%d %H}", r["valid_to"] and f"{r['valid_to']:%d %H}") for r in got] == want
        assert [r["is_current"] for r in got] == [False] * 4 + [True]


def test_upsert_table_touches_only_changed_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.write_buckets(spark.range(40).selectExpr("id AS k", "1 AS version", "'a' AS v"), path, "k", 8)
    def stamps():
        return {p.parent.name: p.name for p in tmp_path.rglob("*.parquet")}
    before = stamps()
    change = spark.createDataFrame([(7, 2, "b"), (100, 2, "n")], "k long, version int, v string")
    incremental.upsert_table(path, change, "k", "version", 8)
    touched = {f"bucket={r['b']}" for r in change.select(incremental.bucket_of("k", 8).alias("b")).collect()}
    assert {b for b, f in stamps().items() if before.get(b) != f} == touched
    rows = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(rows) == 41 and rows[7] == "b" and rows[100] == "n"


# ---------------------------------------------------------------- reports

def test_reconciliation_reports_losses_and_unknown_sources(spark):
    rows = lambda **n: spark.createDataFrame([(s,) for s, k in n.items() for _ in range(k)], "source_id string")
    counts = reconcile.stage_counts({"bronze": rows(A=3, B=2), "standardized": rows(A=3, B=2), "valid": rows(A=2, B=1, C=1),
                                     "quarantined": rows(A=1), "linked": rows(A=2, B=1)})
    got = {(r["source_id"], r["transition"]) for r in reconcile.exceptions(counts).collect()}
    assert got == {("B", "standardized <> valid + quarantined"), ("C", "standardized <> valid + quarantined"),
                   ("C", "valid <> linked"), ("ALL", "valid <> linked")}


def test_precision_recall(spark):
    df = spark.createDataFrame([(0.9, True), (0.9, True), (0.8, False), (0.7, True), (0.6, False)], "score double, is_match boolean")
    got = [tuple(r) for r in evaluate.precision_recall(df).orderBy(F.desc("threshold")).collect()]
    assert got == [(0.9, 2, 2, 1.0, 0.666667), (0.8, 3, 2, 0.666667, 0.666667), (0.7, 4, 3, 0.75, 1.0), (0.6, 5, 3, 0.6, 1.0)]


def test_spikes_need_a_full_trailing_window(spark):
    rates = spark.createDataFrame([("s", i, 0.1 + 0.01 * (i % 2)) for i in range(7)] + [("s", 7, 0.5), ("t", 0, 0.9)], "s string, b int, r double")
    assert [(r["s"], r["b"]) for r in monitor.rate_spikes(rates, "s", "b", "r", 7, 2.0).collect()] == [("s", 7)]


def test_masks(spark):
    df = spark.createDataFrame([("Ann Lee", "ann@x.io", "9876543210", None)], "n string, e string, p string, z string")
    row = privacy.mask_columns(df, {"n": "characters", "e": "email", "p": "last4", "z": "hash"}).first()
    assert tuple(row) == ("Xxx Xxx", "***@x.io", "******3210", None)


def test_erasure_removes_every_record_of_a_subject(spark):
    walk = spark.createDataFrame([("E1", "a"), ("E1", "b"), ("E2", "c")], "golden_id string, record_uid string")
    records = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "record_uid string")
    subjects = spark.createDataFrame([("E1",), ("E1",)], "golden_id string")
    assert {r[0] for r in privacy.erase_subjects(records, subjects, walk).collect()} == {"c", "d"}


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    from kinfold import session

    class Elsewhere:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)


def test_few_repeated_keys_leave_wide_rows_in_place(spark):
    """Their number is known when the rows are joined, so the rows are not shuffled for the join."""
    rows = [(i % 9, "x" * 50) for i in range(10)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows), "k int, wide string")
    rule = {"rule_id": "R1", "rule_type": "unique", "columns": ["k"], "severity": "ERROR", "description": "once"}
    checked = quality.evaluate(df, [rule], "2026-08-01")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert quality.quarantine(checked).count() == 2


def test_documents_make_their_evidence_once(spark):
    """Counting the evidence and placing it read one written table."""
    from kinfold.operators import lineage
    traced = spark.createDataFrame([("g1", "a", f"e{i}") for i in range(5)] + [("g2", "a", "e")], "golden_id string, section string, evidence string")
    nested = lineage.documents(traced, items=2)
    plan = nested._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "parquet" in plan
    rows = nested.collect()
    assert sorted(e for r in rows for e in r["evidence"]) == ["e", "e0", "e1", "e2", "e3", "e4"]


def test_layers_and_stages_are_zstd(spark, tmp_path):
    """Hexadecimal uids take about half their length."""
    Layers(spark, str(tmp_path)).write(spark.range(5).withColumn("u", F.sha2(F.col("id").cast("string"), 256)), "bronze", "t", "b1")
    assert list(tmp_path.rglob("*.zstd.parquet"))


def test_a_written_stage_leaves_no_shuffle_files(spark):
    """Files of a write went only when the driver's garbage collection came, several stages later."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    rows = spark.range(0, 20_000, 1, 8).groupBy((F.col("id") % 5_000).alias("k")).count()
    before, there = spark.conf.get(session.FREE_SHUFFLES, None), shuffles()
    stage = session.materialize(rows, "freed")
    for _ in range(50):  # they are removed behind the write
        left = shuffles() - there
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(session.FREE_SHUFFLES, None) == before
    assert stage.count() == 5_000 and stage.agg(F.sum("count")).first()[0] == 20_000
