"""The entity store against matching and surveying everything again, batch after batch."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from kinfold.operators import ingest, linkage, survivorship
from kinfold.operators.entity_store import EntityStore
from kinfold.sources.keyed import STAMP, KeyedTable
from kinfold.spec import EntitySpec, SpecError
from test_linkage import COLUMNS, CONFIGS, make

KEPT = ["source_id", "source_record_id", "batch_id", "trust_rank", "source_updated_at"]
ATTRIBUTES = [c for c in COLUMNS if c != "record_uid"]
SCHEMA = ", ".join(f"{c} string" for c in ["record_uid", *ATTRIBUTES, "source_id", "source_record_id", "batch_id", "source_updated_at"]) + ", trust_rank int"


def spec_for(matching) -> EntitySpec:
    return EntitySpec(entity="person", attributes=tuple(ATTRIBUTES), matching=matching, survivorship={
        a: [("most_recent", "source_precedence", "non_null_longest")[i % 3]] for i, a in enumerate(ATTRIBUTES)})


def frame(spark, records, batch):
    """Ranks and dates follow from the record, so that a changed one competes anew."""
    def row(r):
        h = random.Random(str(sorted(r.items(), key=str))).randrange(10_000)
        return (*[r[c] for c in ["record_uid", *ATTRIBUTES]], f"S{h % 3}", r["record_uid"], batch, f"2026-{1 + h % 12:02d}-{1 + h % 28:02d}", h % 5)
    return spark.createDataFrame([row(r) for r in records], SCHEMA)


def state(store):
    won = store.winners.read()
    rows = {r["root_uid"]: tuple(r[a] and tuple(r[a]) for a in ATTRIBUTES) for r in won.collect()}
    return {(r["record_uid"], r["root_uid"]) for r in store.members.read().collect()}, rows, \
        {(bytes(r["group"]), r["root_uid"]) for r in store.evidence.read().collect()}, \
        {(r["record_uid"], r["root_uid"], r["batch_id"]) for r in store.entities.read().collect()}


def recomputed(spark, spec, df):
    roots = linkage.clusters(df, spec.matching).select("record_uid", "root_uid")
    rooted = df.join(roots, "record_uid")
    won = survivorship.winners(rooted.withColumnRenamed("root_uid", "cluster_id"), spec)
    groups = linkage.key_groups(df, spec.matching).join(roots, "record_uid").select("group", "root_uid").distinct()
    return {(r["record_uid"], r["root_uid"]) for r in roots.collect()}, \
        {r["cluster_id"]: tuple(r[a] and tuple(r[a]) for a in ATTRIBUTES) for r in won.collect()}, \
        {(bytes(r["group"]), r["root_uid"]) for r in groups.collect()}, \
        {(r["record_uid"], r["root_uid"], r["batch_id"]) for r in rooted.collect()}


@pytest.mark.parametrize("name", ["shipped", "fuzzy matches"])
def test_batches_equal_recomputation(spark, name, tmp_path):
    """Inserts, changes that split and merge, returns to an earlier state, removals, and a replay."""
    spec = spec_for(CONFIGS[name])
    rng = random.Random(7)
    pool = {r["record_uid"]: r for r in make(11, 90)}
    other = dict(zip(pool, make(12, 90)))
    uids = sorted(pool)
    now = {u: pool[u] for u in uids[:60]}
    store = EntityStore(spark, str(tmp_path / "store"), spec)
    assert not store.is_started()
    first = frame(spark, list(now.values()), "b0")
    store.start(first, linkage.clusters(first, spec.matching), "b0", "2026-01-01")
    batch_of = dict.fromkeys(now, "b0")
    for step in range(1, 4 if name == "shipped" else 3):
        batch = f"b{step}"
        changed = {u: {**pool[u], **{c: other[u][c] for c in ("email", "phone")}} if step % 2 else pool[u] for u in rng.sample(sorted(now), 8)}
        removed = [u for u in rng.sample(sorted(now), 7) if u not in changed]
        arriving = {u: pool[u] for u in rng.sample(uids, 9) if u not in now}
        upserts = {**changed, **arriving}
        df = frame(spark, list(upserts.values()), batch)
        gone = spark.createDataFrame([(u,) for u in [*removed, "nobody"]], "record_uid string")
        increment = store.apply(df, gone, batch, f"2026-01-0{step + 1}")
        if step == 2 and name == "shipped":  # a replay reads what was before it
            increment = store.apply(df, gone, batch, f"2026-01-0{step + 1}")
        before = dict(now)
        now = {u: r for u, r in {**now, **upserts}.items() if u not in removed}
        batch_of = {u: batch if u in upserts else batch_of[u] for u in now}
        frames = [frame(spark, [r for u, r in now.items() if batch_of[u] == b], b) for b in sorted(set(batch_of.values()))]
        wanted = recomputed(spark, spec, reduce(lambda a, b: a.unionByName(b), frames))
        assert state(store) == wanted
        touched = {r[0] for r in increment.touched.collect()}
        retired = {r[0] for r in increment.retired.collect()}
        assert touched <= set(wanted[1]) and not retired & set(wanted[1]) and {r[0] for r in increment.assigned.collect()} >= set(upserts)
        assert len(before) and all(r["batch_id"] == batch for r in store.golden(roots=increment.touched).collect())
    if name == "shipped":
        assert store.winners.maintain("b3", deltas=2) and state(store) == wanted
        with pytest.raises(SpecError):
            store.winners.read(before="b3")


def test_decisions_of_a_batch(spark, tmp_path):
    """A batch lists the pairs of what is new with what was there, each as matching everything would list it."""
    spec = spec_for(CONFIGS["shipped"])
    records = make(21, 80)
    old, new = records[:60], records[60:]
    store = EntityStore(spark, str(tmp_path / "store"), spec)
    first, later = frame(spark, old, "b0"), frame(spark, new, "b1")
    store.start(first, linkage.clusters(first, spec.matching), "b0", "2026-01-01")
    increment = store.apply(later, later.select("record_uid").filter("false"), "b1", "2026-01-02")
    whole = first.unionByName(later)
    stands = {r["record_uid"]: r["first_uid"] for r in linkage.profile_members(whole, spec.matching).collect()}
    news = {stands[r["record_uid"]] for r in new}
    wanted = {tuple(r) for r in linkage.fuzzy_pairs(whole, spec.matching).collect()}
    wanted = {r for r in wanted if {stands[r[0]], stands[r[1]]} & news}
    got = {tuple(r) for r in increment.decisions.filter("method = 'probabilistic'").collect()}
    assert got == wanted and wanted
    links = {tuple(r) for r in linkage.deterministic_decisions(whole, spec.matching).collect()}
    listed = {tuple(r) for r in increment.decisions.filter("method = 'deterministic'").collect()}
    assert listed <= links and all(r in listed for r in links if {r[0], r[1]} & {n["record_uid"] for n in new})


def test_lookups_read_only_their_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.start(spark.range(200).selectExpr("id AS k", "'a' AS v", "id % 7 AS w"), ["k"], ["k"], "007", buckets=16)
    table.change(spark.createDataFrame([(5, "b", 0), (500, "n", 1)], "k long, v string, w long"), spark.createDataFrame([(6,), (5,)], "k long"), "008")
    rows = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 200 and rows[5] == "b" and rows[500] == "n" and 6 not in rows
    assert table.read(before="008").count() == 200 and table.read(upto="007").filter("k = 5").first()["v"] == "a"
    asked = table.lookup(spark.createDataFrame([(5,), (7,)], "k long"))
    assert {(r["k"], r["v"]) for r in asked.collect()} == {(5, "b"), (7, "a")}
    plan = asked._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert asked.select("k", "v")._jdf.queryExecution().toString().count("w#") and len(asked.inputFiles()) > 0
    stamps = {r["k"]: r[STAMP] for r in table.read(stamped=True).collect()}
    assert stamps[5] == "008" and stamps[7] == "007"
    table.change(spark.createDataFrame([], "k long, v string, w long"), None, "009")
    assert table.read().count() == 200
    with pytest.raises(SpecError):
        table.change(table.read(), None, "007")


def test_versions_give_every_state_back(spark, tmp_path):
    """Random changes and removals, folds in between: the versions known as of a batch are the table as of it."""
    rng = random.Random(5)
    table = KeyedTable(spark, str(tmp_path / "t"))
    schema, now, states = "k long, v string", {k: "a" for k in range(30)}, {}
    table.start(spark.createDataFrame(sorted(now.items()), schema), ["k"], ["k"], "b0", buckets=4)
    states["b0"] = dict(now)
    for step in range(1, 6):
        ups = {k: rng.choice("ab") for k in rng.sample(range(40), 9)}
        gone = [k for k in rng.sample(sorted(now), 5) if k not in ups]
        table.change(spark.createDataFrame(sorted(ups.items()), schema), spark.createDataFrame([(k,) for k in gone], "k long"), f"b{step}")
        now = {k: v for k, v in {**now, **ups}.items() if k not in gone}
        states[f"b{step}"] = dict(now)
        assert {r["k"]: r["v"] for r in table.read().collect()} == now
        if step in (2, 4):
            assert table.maintain(f"b{step}", deltas=0)
    rows = table.versions().collect()
    for batch, state in states.items():
        known = [r for r in rows if r["recorded_from"] <= batch and (r["recorded_to"] is None or batch < r["recorded_to"])]
        assert {r["k"]: r["v"] for r in known} == state and len(known) == len(state)
    for r in rows:  # no two versions in a row are equal
        assert not any(o["k"] == r["k"] and o["recorded_from"] == r["recorded_to"] and o["v"] == r["v"] for o in rows)


def test_vanished_keys_and_returns(spark):
    spec = EntitySpec.parse({"entity": "e", "attributes": ["full_name"], "sources": [
        {"source_id": s, "format": "csv", "path": "x", "load_type": kind, "field_map": {"id": "source_record_id"}}
        for s, kind in (("F", "full"), ("G", "full"), ("H", "full"), ("I", "incremental"))]})
    landed = spark.createDataFrame([("a", "F", "b1"), ("b", "F", "b1"), ("b", "F", "b2"), ("c", "G", "b1"), ("d", "H", "b1"), ("e", "I", "b1")],
                                   "record_uid string, source_id string, batch_id string")
    seen = spark.createDataFrame([("a", "F"), ("a", "F"), ("x", "F"), ("y", "G"), ("z", "I")], "record_uid string, source_id string")
    broken = spark.createDataFrame([("G",)], "source_id string")
    # G has an unreadable line, H no row at all, I is not a full load
    assert [tuple(r) for r in ingest.vanished_keys(landed, seen, broken, spec).collect()] == [("b", "F")]
    retired = spark.createDataFrame([("b", "F", "b3"), ("c", "G", "b1")], "record_uid string, source_id string, batch_id string")
    later = landed.unionByName(spark.createDataFrame([("c", "G", "b4")], landed.schema))
    assert sorted((r["record_uid"], r["batch_id"]) for r in ingest.still_present(later, retired).collect()) == [
        ("a", "b1"), ("c", "b4"), ("d", "b1"), ("e", "b1")]
