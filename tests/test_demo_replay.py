"""The published demo, from landing files to golden records, through the table-writing batch job."""

import json

import demo
import pytest
from pyspark.sql import functions as F

from kinfold.operators import lineage, linkage
from kinfold.plans.customer import AS_OF, CUSTOMER
from kinfold.plans.mastering import run_batch
from kinfold.sources.tables import Layers


def land(root, crm=demo.CRM, web=demo.WEB, legacy=demo.LEGACY):
    for folder, name, text in [
        ("crm", "crm_extract.csv", crm), ("legacy", "legacy_extract.dat", legacy),
        ("web", "web_extract.json", "\n".join(json.dumps(dict(zip(demo.WEB_FIELDS, r))) for r in web)),
    ]:
        target = root / "landing" / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("demo")
    layers = Layers(spark, str(base / "tables"))
    work = run_batch(spark, CUSTOMER, layers, land(base), "20260801-a", AS_OF, id_length=12)
    return layers, work, base


def short(row, *cols):
    return tuple(row[c][:8] for c in cols)


def test_counts_by_source(run):
    layers, _, _ = run
    counts = {r["source_id"]: r.asDict() for r in layers.read("ops", "stage_counts").collect()}
    assert [counts["ALL"][c] for c in ("bronze", "standardized", "valid", "quarantined", "linked")] == [24, 24, 19, 5, 19]
    assert {s: counts[s]["valid"] for s in ("CRM", "WEB", "LEGACY")} == {"CRM": 7, "WEB": 8, "LEGACY": 4}
    assert {s: counts[s]["quarantined"] for s in ("CRM", "WEB", "LEGACY")} == {"CRM": 3, "WEB": 2, "LEGACY": 0}


def test_quarantine_reasons(run):
    layers, _, _ = run
    rows = layers.read("silver", "dq_results").filter("severity = 'ERROR'").join(
        layers.read("bronze", "customer_raw").select("record_uid", "source_record_id").distinct(), "record_uid")
    assert {(r["source_id"], r["source_record_id"], r["rule_id"]) for r in rows.collect()} == demo.QUARANTINED
    assert layers.read("silver", "dq_results").count() == 5


def test_golden_records(run):
    _, work, _ = run
    rows = work.golden.select("golden_id", "full_name", "email", "phone", "city", "state", "date_of_birth").collect()
    assert {tuple(r) for r in rows} == demo.GOLDEN


def test_match_decisions(run):
    _, work, _ = run
    roots = {}
    for r in linkage.deterministic_links(work.valid, CUSTOMER.matching).collect():
        roots.setdefault(r["record_uid"][:8], set()).add(r["root_uid"][:8])
    for a, b in demo.MATCHES:
        assert b in roots.get(a, set()) or roots.get(a, {0}) & roots.get(b, {1})
    everything = linkage.fuzzy_pairs(work.valid, CUSTOMER.matching, floor=0.0).collect()
    assert {(*short(r, "record_uid_1", "record_uid_2"), r["score"], r["decision"]) for r in everything} == demo.FUZZY
    bands = {(r["decision"], r["method"]): int(r["record_pairs"]) for r in linkage.match_bands(work.valid, CUSTOMER.matching).collect()}
    assert bands == {("MATCH", "deterministic"): 9, ("MATCH", "probabilistic"): 0, ("REVIEW", "probabilistic"): 1,
                     ("REJECTED_FP_GUARD", "probabilistic"): 1, ("NO_MATCH", "probabilistic"): 0}
    assert linkage.candidate_pair_count(work.valid, CUSTOMER.matching).first()[0] == 11


def test_evidence_on_request(run, spark):
    """The rejected pair of the published run is found from either of its records, with what kept them apart."""
    _, work, _ = run
    rejected = next(f for f in demo.FUZZY if f[3] == "REJECTED_FP_GUARD")
    for uid in rejected[:2]:
        wanted = work.valid.filter(F.col("record_uid").startswith(uid)).select("record_uid")
        rows = linkage.compared_pairs(work.valid, wanted, CUSTOMER.matching).collect()
        assert {(*short(r, "record_uid_1", "record_uid_2"), r["score"], r["decision"]) for r in rows if r["method"] == "probabilistic"} == {
            f for f in demo.FUZZY if uid in f[:2]}
        assert any(r["conflicts"] for r in rows if r["decision"] == "REJECTED_FP_GUARD")
    everything = linkage.compared_pairs(work.valid, work.valid, CUSTOMER.matching)
    assert everything.count() == 11 and everything.filter("method = 'deterministic'").count() == 9
    assert linkage.compared_pairs(work.valid, work.valid.filter("false"), CUSTOMER.matching).count() == 0


def test_high_water_marks_and_audit(run):
    layers, _, _ = run
    marks = {r["source_id"]: str(r["high_water_mark"])[:10] for r in layers.read("ops", "high_water_marks").collect()}
    assert marks == {"CRM": "2026-06-15", "WEB": "2026-07-12"}
    audit = {(r["stage"], r["source_id"]): r["metrics"] for r in layers.read("ops", "audit_log").collect()}
    assert audit["bronze_ingest", "LEGACY"] == {"rows_ingested": 4}
    assert audit["dq_validation", "ALL"] == {"rows_in": 24, "rows_valid": 19, "rows_quarantined": 5, "rule_failures": 5}
    assert audit["golden_record", "ALL"] == {"golden_records": 12}
    assert audit["silver_standardize", "ALL"] == {"rows_standardized": 24}
    assert set(audit["identity_resolution", "ALL"]) == {"pairs_listed", "auto_matched", "review_queued", "rejected_by_guard", "entities"}
    assert audit["identity_resolution", "ALL"]["entities"] == 12
    times = {r["stage"]: r["event_ts"] for r in layers.read("ops", "audit_log").collect()}
    stages = ["bronze_ingest", "silver_standardize", "dq_validation", "identity_resolution", "golden_record", "reconciliation"]
    assert sorted(times, key=times.get) == stages and len(set(times.values())) == 6
    assert audit["reconciliation", "ALL"] == {"exceptions": 0}


def test_survivorship_evidence(run):
    _, work, _ = run
    vikram = {r["attribute"]: r for r in work.decisions.filter("cluster_id = 'E-f0fabc3082fa'").collect()}
    assert (vikram["full_name"]["winning_source"], vikram["phone"]["winning_source"]) == ("CRM", "WEB")
    assert vikram["phone"]["strategy"] == "most_recent+source_precedence"
    rahul = work.decisions.filter("cluster_id = 'E-edf9ca99e803' AND attribute = 'address_line'").first()
    assert (rahul["golden_value"], rahul["winning_source"]) == ("121 Golf Course Road", "WEB")


def test_lineage_trace(run, spark):
    _, work, _ = run
    amit = spark.createDataFrame([("E-72a37b16da9f",)], ["golden_id"])
    rows = work.trace(amit).collect()
    sections = {}
    for r in rows:
        sections.setdefault(r["section"], []).append(json.loads(r["evidence"]))
    assert {s["source_record_id"] for s in sections["source_records"]} == {"C003", "U0003", "L00002"}
    phone = next(t for t in sections["transforms"] if t["attribute"] == "phone" and t["record_uid"].startswith("72a3"))
    assert (phone["raw_value"], phone["standardized_value"]) == ("+91-99001-12233", "9900112233")
    assert "dq_annotations" not in sections
    assert len(sections["survivorship_decisions"]) == 8
    assert {m["decision"] for m in sections["match_decisions"]} == {"MATCH"}


def test_documents_split_large_entities(run, spark):
    _, work, _ = run
    rows = work.trace(work.golden.select("golden_id"))
    whole = lineage.documents(rows).collect()
    assert len({r["golden_id"] for r in whole}) == 12 and {r["part"] for r in whole} == {0}
    pieces = lineage.documents(rows, items=5)
    assert pieces.columns == lineage.documents(rows).columns and max(r["part"] for r in pieces.collect()) > 0
    assert sum(len(r["evidence"]) for r in pieces.collect()) == rows.count()


def test_sample_entities(run):
    _, work, _ = run
    rows = [tuple(r) for r in lineage.sample_entities(work.crosswalk, 3, 10).collect()]
    assert rows == [("E-72a37b16da9f", 3), ("E-edf9ca99e803", 3)]


def test_second_batch_keeps_history_and_takes_only_news(run, spark):
    layers, _, base = run
    later = base / "later"
    crm = demo.CRM.splitlines()[0] + "\n" + "\n".join([
        # unchanged row at the mark, a new version, a new customer, and an old row that must not return
        "C007,Karan Mehta,karan.mehta@gmail.com,+91-94321-09876,55 Ring Rd,Gurgaon,Haryana,India,1991-12-19,2026-06-15",
        "C001,Rahul Sharma,rahul.sharma@gmail.com,+91-98765-43210,1 New Rd,Gurgaon,Haryana,India,1990-04-12,2026-07-20",
        "C010,Meera Joshi,meera.j@gmail.com,,2 Cross St,Pune,Maharashtra,India,1994-02-14,2026-06-15",
        "C002,Priya Nair,priya.nair@yahoo.com,+91-98123-45678,4 Palm St,Bangalore,Karnataka,India,1988-11-02,2026-06-01",
    ]) + "\n"
    land(later, crm=crm, web=[], legacy=demo.LEGACY.splitlines()[0] + "\n")
    work = run_batch(spark, CUSTOMER, layers, str(later), "20260802-a", AS_OF, previous="20260801-a", id_length=12)
    landed = layers.read("bronze", "customer_raw", "20260802-a")
    assert {r["source_record_id"] for r in landed.collect()} == {"C001", "C010"}
    assert layers.read("bronze", "customer_raw").count() == 26
    golden = {r["golden_id"]: r for r in work.golden.collect()}
    assert len(golden) == 12
    assert golden["E-edf9ca99e803"]["address_line"] == "1 New Road"
    assert golden["E-edf9ca99e803"]["batch_id"] == "20260802-a"
    meera = work.crosswalk.filter(F.col("source_record_id").isin("C010", "U9999")).select("golden_id").distinct()
    assert meera.count() == 1
