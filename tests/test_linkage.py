"""Pair decisions, counts and clusters against brute force, under several configurations."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import incremental, linkage
from kinfold.operators.components import connected_components
from kinfold.plans.customer import MATCHING
from kinfold.spec import Matching

COLUMNS = ["record_uid", "full_name", "address_line", "email", "phone", "date_of_birth", "country"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def indel(a, b):
    return 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))


def token_sort(a, b):
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    a, b = set(a.split()), set(b.split())
    if not a or not b:
        return 0.0
    both, ra, rb = " ".join(sorted(a & b)), " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if both and (not ra or not rb):
        return 1.0
    if not both:
        return indel(ra, rb)
    la, lb = len(both) + 1 + len(ra), len(both) + 1 + len(rb)
    apart = 1 - (len(ra) + len(rb) - 2 * lcs(ra, rb)) / (la + lb)
    return max(apart, 1 - (1 + len(ra)) / (len(both) + la), 1 - (1 + len(rb)) / (len(both) + lb))


def blocks(r):
    letters = "".join(c for c in (r["full_name"] or "").lower() if "a" <= c <= "z")
    return {k for k in ("N|" + letters[:3] if letters else None, r["phone"] and "P|" + r["phone"][-4:],
                        r["email"] and "E|" + r["email"][:4]) if k}


def brute(records, spec):
    """{(uid, uid): (deterministic, score, decision)} over every compared pair."""
    out = {}
    for a, b in itertools.combinations(sorted(records, key=lambda r: r["record_uid"]), 2):
        if not blocks(a) & blocks(b):
            continue
        same = lambda c: a[c] is not None and a[c] == b[c]
        det = any(all(same(c) for c in k) for k in spec.deterministic)
        score = 0.0
        for f in spec.features:
            x, y = a[f.attribute], b[f.attribute]
            if x is not None and y is not None:
                score += f.weight * {"exact": lambda p, q: float(p == q), "token_sort_ratio": token_sort,
                                     "token_set_ratio": token_set}[f.method](x, y)
        score = round(score, 4)
        clash = any(a[c] is not None and b[c] is not None and a[c] != b[c] for c in spec.conflict_columns)
        decision = ("MATCH" if det else "REJECTED_FP_GUARD" if clash else "MATCH" if score >= spec.auto_match
                    else "REVIEW" if score >= spec.review else "NO_MATCH")
        out[a["record_uid"], b["record_uid"]] = (det, score, decision)
    return out


def make(seed, n=120):
    """Few distinct values, many nulls and copies: hot blocks, hot keys, hot profiles."""
    rng = random.Random(seed)
    names = ["Ann Lee", "Lee Ann", "Anna Lee", "Bob Stone", "Bobby Stone", "Ann", "安娜 李", "", "José Díaz", None]
    streets = ["1 Hill Road", "Hill Road 1", "1 Hill Street", "9 Lake View", "9 Lake View Flat 2", "", None]
    pick = lambda xs, w=None: rng.choices(xs, w)[0]
    return [dict(zip(COLUMNS, (
        f"{rng.getrandbits(64):016x}{i:04d}", pick(names), pick(streets),
        pick(["ann@x.io", "bob@x.io", "anna@y.io", "bobby@y.io", None], [1, 1, 1, 1, 6]),
        pick(["9000011111", "9000022222", "8000011111", None], [2, 2, 2, 3]),
        pick(["1990-01-01", "1991-01-01", None], [5, 2, 2]), pick(["IN", "US", None], [6, 1, 1])))) for i in range(n)]


def config(auto=0.85, review=0.65, deterministic=(("email",), ("phone", "date_of_birth")), weights=(0.4, 0.25, 0.15, 0.1, 0.1)):
    raw = {**MATCHING, "thresholds": {"auto_match": auto, "review": review}, "deterministic": [list(k) for k in deterministic],
           "features": [{**f, "weight": w} for f, w in zip(MATCHING["features"], weights)]}
    return Matching.parse(raw)


CONFIGS = {
    "shipped": config(),
    "fuzzy matches": config(auto=0.7, review=0.55),
    "no deterministic key in the blocks": config(deterministic=(("country", "date_of_birth"),), auto=0.8),
    "exact features carry the score": config(weights=(0.2, 0.1, 0.2, 0.3, 0.2), auto=0.75, review=0.6),
}


def frame(spark, records):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in records], ", ".join(f"{c} string" for c in COLUMNS))


def profile_pairs(truth, records, spec, floor):
    """Brute-force decisions folded to the rows `fuzzy_pairs` promises."""
    key = {r["record_uid"]: tuple(r[c] for c in spec.columns) for r in records}
    members = {}
    for uid, k in key.items():
        members.setdefault(k, []).append(uid)
    out = {}
    for (a, b), (det, score, decision) in truth.items():
        if det or score < floor:
            continue
        one, two = members[key[a]], members[key[b]]
        ends = (min(one), max(one)) if key[a] == key[b] else tuple(sorted((min(one), min(two))))
        n = out.get(ends, (0,))[0]
        out[ends] = (n + 1, score, decision)
    return out


def closure(uids, edges):
    parent = {u: u for u in uids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[a] = b
    return {u: find(u) for u in uids}


@pytest.mark.parametrize("name", CONFIGS)
def test_pairs_counts_and_clusters_equal_brute_force(spark, name):
    spec, records = CONFIGS[name], make(list(CONFIGS).index(name))
    df, truth = frame(spark, records), brute(records, spec)
    for floor, split in ((None, 20_000), (None, 3), (0.0, 7)):
        rows = linkage.fuzzy_pairs(df, spec, floor, split).collect()
        got = {(r["record_uid_1"], r["record_uid_2"]): (r["record_pairs"], r["score"], r["decision"]) for r in rows}
        assert len(got) == len(rows)
        assert got == profile_pairs(truth, records, spec, spec.review if floor is None else floor)
    assert linkage.candidate_pair_count(df, spec).first()[0] == len(truth)
    assert linkage.open_pair_count(df, spec).first()[0] == sum(not t[0] for t in truth.values())
    own = df.withColumn("who", F.substring("record_uid", 1, 1))
    assert linkage.open_pair_count(own, spec, "who").first()[0] == sum(not t[0] and p[0][0] == p[1][0] for p, t in truth.items())
    asked = {r["record_uid"] for r in records[::9]}
    some = linkage.compared_pairs(df, df.filter(F.col("record_uid").isin(*asked)), spec).collect()
    assert {(r["record_uid_1"], r["record_uid_2"]): (r["method"] == "deterministic", r["decision"]) for r in some} == {
        p: (t[0], t[2]) for p, t in truth.items() if asked & set(p)} and len(some) == len({(r["record_uid_1"], r["record_uid_2"]) for r in some})
    bands = {(r["decision"], r["method"]): int(r["record_pairs"]) for r in linkage.match_bands(df, spec).collect()}
    expected = dict.fromkeys(bands, 0)
    for det, _, decision in truth.values():
        expected[decision, "deterministic" if det else "probabilistic"] += 1
    assert bands == expected
    found = {r["record_uid"]: r["root_uid"] for r in linkage.clusters(df, spec).collect()}
    assert found == closure([r["record_uid"] for r in records], [p for p, t in truth.items() if t[2] == "MATCH"])


@pytest.mark.parametrize("name", ["shipped", "fuzzy matches"])
def test_increment_equals_matching_everything(spark, name):
    spec, records = CONFIGS[name], make(77, 90)
    old, new = records[:60], records[60:]
    # ten stored records come back changed: their clusters may split or merge
    changed = [{**r, "email": n["email"], "phone": n["phone"]} for r, n in zip(old[:10], make(78, 10))]
    stored, incoming = frame(spark, old), frame(spark, new + changed)
    before = linkage.clusters(stored, spec).select("record_uid", "root_uid")
    after = incremental.apply_increment(before, *incremental.match_increment(incoming, stored, before, spec))
    whole = linkage.clusters(frame(spark, changed + old[10:] + new), spec)
    assert {tuple(r) for r in after.collect()} == {(r["record_uid"], r["root_uid"]) for r in whole.collect()}
    assert after.count() == 90


def test_null_on_the_right_does_not_lift_the_guard(spark):
    """A missing e-mail on one side must not turn a date-of-birth conflict into a match, in either uid order."""
    for left, right in (("a", "b"), ("b", "a")):
        df = frame(spark, [
            dict(zip(COLUMNS, (left, "Ann Lee", "1 Hill Road", "ann@x.io", "9000011111", "1990-01-01", "IN"))),
            dict(zip(COLUMNS, (right, "Ann Lee", "1 Hill Road", None, "9000011111", "1991-01-01", "IN")))])
        assert [r["decision"] for r in linkage.fuzzy_pairs(df, config()).collect()] == ["REJECTED_FP_GUARD"]


def test_order_of_input_and_pairs_does_not_matter(spark):
    records = make(5, 60)
    one = {tuple(r) for r in linkage.clusters(frame(spark, records), config()).collect()}
    two = {tuple(r) for r in linkage.clusters(frame(spark, records[::-1]).repartition(7), config()).collect()}
    assert one == two


def test_empty_input(spark):
    df = frame(spark, make(1, 1)).filter("false")
    assert linkage.match_pairs(df, config()).count() == 0
    assert linkage.clusters(df, config()).count() == 0
    assert {int(r["record_pairs"]) for r in linkage.match_bands(df, config()).collect()} == {0}


def test_evidence_follows_the_weights():
    assert linkage.reachable_evidence(config(), 0.85) is None  # key matches aside, no pair can reach it
    assert linkage.reachable_evidence(config(), 0.65) == [()]
    assert linkage.reachable_evidence(config(), 0.70) == [("phone",), ("date_of_birth",)]
    assert linkage.reachable_evidence(config(), 0.80) is None


def test_components_of_chains_stars_and_noise(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("s000", f"s{i:03d}") for i in range(1, 40)]
    noise = [("x", "x"), ("c003", "c002"), ("c002", "c003"), ("s001", "s000")]
    rng = random.Random(3)
    loose = [(f"r{rng.randrange(50):03d}", f"r{rng.randrange(50):03d}") for _ in range(45)]
    edges = chain + star + noise + loose
    rng.shuffle(edges)
    found = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(edges, ["src", "dst"])).collect()}
    truth = closure({v for e in edges for v in e}, edges)
    assert found == {v: c for v, c in truth.items() if v != "x" and sum(c == d for d in truth.values()) > 1}
    again = spark.createDataFrame([(v, c) for v, c in found.items()], ["src", "dst"])
    assert {r["vertex"]: r["component"] for r in connected_components(again).collect()} == found


def test_oversize_block_is_reported_not_dropped(spark):
    df = frame(spark, [dict(zip(COLUMNS, (f"u{i}", "Ann Lee", None, None, None, None, None))) for i in range(30)])
    row = linkage.oversize_blocks(df, config(), 20).first()
    assert (row["block_key"], row["n_records"], int(row["n_pairs"])) == ("N|ann", 30, 435)
    assert linkage.fuzzy_pairs(df, config(), 0.0).agg(F.sum("record_pairs")).first()[0] == 435


def test_long_texts_are_compared_whole(spark):
    """Beyond the length where equality is implied, almost equal texts still meet."""
    words = " ".join(f"w{i:04d}" for i in range(1500))
    near = words[:-1] + "x"
    rows = [("a", near, "1 Hill Road", None, None, None, "IN"), ("b", words, "1 Hill Road", None, None, None, "IN"),
            ("c", "Ann Lee", words, None, None, None, "IN"), ("d", "Ann Lee", near, None, None, None, "IN"),
            ("e", "Ann Lee", words + " more", None, None, None, "IN")]
    records = [dict(zip(COLUMNS, r)) for r in rows]
    spec = config()
    # a common first word puts all of them into one name block
    records = [{**r, "full_name": "abc " + r["full_name"]} for r in records]
    got = {(r["record_uid_1"], r["record_uid_2"], r["score"], r["decision"]) for r in linkage.fuzzy_pairs(frame(spark, records), spec).collect()}
    assert got == {("a", "b", 0.65, "REVIEW"), ("c", "d", 0.65, "REVIEW"), ("c", "e", 0.65, "REVIEW")}  # d and e reach 0.6499


def test_third_of_all_rows_under_one_name(spark):
    """A placeholder name in a third of the rows: pairs must share address words, so few are formed."""
    rows = [(f"u{i:05d}", "Unknown" if i % 3 == 0 else f"N{i} X{i}", f"{i} Hill Road", f"m{i}@x.io", f"9{i:09d}", None, "IN")
            for i in range(3000)] + [("v1", "Unknown", "3 Hill Road", None, "8123456789", None, "IN")]
    df = frame(spark, [dict(zip(COLUMNS, r)) for r in rows])
    got = [tuple(r)[:4] for r in linkage.fuzzy_pairs(df, config()).collect()]
    assert got == [("u00003", "v1", 1, 0.65)]


@pytest.mark.parametrize("name", ["shipped", "no deterministic key in the blocks"])
def test_compared_pairs_in_tiles(spark, name):
    """Blocks cut into tiles give every pair of the wanted records once, as uncut blocks do."""
    records, spec = make(5, 90), CONFIGS[name]
    df = frame(spark, records)
    asked = {r["record_uid"] for r in records[::7]}
    wanted = spark.createDataFrame([(u,) for u in sorted(asked)], "record_uid string")
    found = linkage.compared_pairs(df, wanted, spec, split_rows=4).collect()
    truth = {k: v for k, v in brute(records, spec).items() if set(k) & asked}
    assert len(found) == len(truth)
    for r in found:
        sure, score, decision = truth[r["record_uid_1"], r["record_uid_2"]]
        assert (r["method"] == "deterministic", r["decision"]) == (sure, decision)
        assert r["score"] == (1.0 if sure else pytest.approx(score, abs=1e-4))


@pytest.mark.parametrize("floor,split", [(0.3, 5_000), (0.3, 4), (0.65, 5_000)])
def test_scores_are_counted_without_pairs(spark, floor, split):
    """Counts per score and truth equal those of the single pairs, with whole blocks (0.3, in tiles too) and with slots (0.65)."""
    records, spec = make(7, 110), CONFIGS["shipped"]
    who = {r["record_uid"]: r["record_uid"][0] if r["record_uid"][1] > "3" else None for r in records}
    df = frame(spark, records).join(spark.createDataFrame(list(who.items()), "record_uid string, who string"), "record_uid")
    expected = {}
    for (a, b), (n, score, _) in profile_pairs(brute(records, spec), records, spec, floor).items():
        key = {r["record_uid"]: tuple(r[c] for c in spec.columns) for r in records}
        if key[a] != key[b]:
            place = (score, who[a] is not None and who[a] == who[b])
            expected[place] = expected.get(place, 0) + n
    counted = linkage.score_counts(df, spec, floor, "who", split)
    assert {(r["score"], r["is_same"]): r["record_pairs"] for r in counted.collect()} == expected
    assert sum(s for _, s in expected) and len(expected) > 3


@pytest.mark.parametrize("floor,split", [(0.3, 5_000), (0.3, 4), (0.65, 5_000)])
def test_features_are_counted_without_pairs(spark, floor, split):
    """Similarities are counted as the listed pairs have them, less a fifth by hash of the pair, for uids of any length."""
    records, spec = make(8, 110), CONFIGS["shipped"]
    for i, r in enumerate(records):
        r["record_uid"] = (r["record_uid"] * 4)[:1 + i % 77] + f"é{i}"
    df = frame(spark, records).withColumn("who", F.when(F.col("phone") > "8500000000", F.substring("record_uid", 1, 1)))
    sims = [f"sim_{f.attribute}" for f in spec.features]
    pairs = linkage.pair_features(df, spec, floor, same="who").withColumn("fold", F.pmod(F.xxhash64("record_uid_1", "record_uid_2"), F.lit(5)))
    carried = linkage.pair_features(df, spec, floor, carried=("who",)).filter("who_1 = who_2").count()
    listed = pairs.collect()
    assert carried == sum(r["is_same"] for r in listed) > 0 and len({r["fold"] for r in listed}) == 5
    expected = {}
    for r in listed:
        if r["fold"] != 0:
            place = (*[r[s] for s in sims], r["is_same"])
            expected[place] = expected.get(place, 0) + 1
    counted = linkage.feature_counts(df, spec, floor, "who", (5, 0), split).collect()
    assert {(*[r[s] for s in sims], r["is_same"]): r["pairs"] for r in counted} == expected


def test_scorer_is_applied_as_one_expression(spark):
    """The fitted model gives each pair the probability that the pipeline gives it, without vectors per pair."""
    from pyspark.ml.functions import vector_to_array
    from kinfold.operators import evaluate
    rng, spec = random.Random(4), CONFIGS["shipped"]
    sims = [f"sim_{f.attribute}" for f in spec.features]
    rows = [(*k, k[0] + rng.random() > 0.9, rng.randrange(1, 9)) for k in ([rng.choice([0.0, 0.3, 1.0]) for _ in sims] for _ in range(200))]
    data = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in sims) + ", is_match boolean, pairs bigint")
    model = evaluate.train_scorer(data, spec, weight="pairs")
    scored = evaluate.apply_scorer(model, data)
    assert "UDF" not in scored._jdf.queryExecution().optimizedPlan().toString()
    expected = {tuple(r[s] for s in sims): r["p"] for r in model.transform(data).withColumn("p", vector_to_array("probability")[1]).collect()}
    for r in scored.collect():
        assert r["match_probability"] == pytest.approx(expected[tuple(r[s] for s in sims)], abs=1e-12)


def test_compared_pairs_leave_their_tile_scored(spark):
    """No row is made per pair before it is scored; the columns that differ are named in the order of the spec."""
    records, spec = make(9, 80), CONFIGS["shipped"]
    df = frame(spark, records)
    by_uid = {r["record_uid"]: r for r in records}
    found = linkage.compared_pairs(df, df.limit(40), spec, split_rows=6)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "__tile" not in "".join(line for line in plan.splitlines() if "Join" in line)
    rows = found.collect()
    for r in rows:
        a, b = by_uid[r["record_uid_1"]], by_uid[r["record_uid_2"]]
        assert r["conflicts"] == "+".join(c for c in spec.conflict_columns if a[c] is not None and b[c] is not None and a[c] != b[c])
    assert len({r["conflicts"] for r in rows}) == 4


@pytest.mark.parametrize("name", ["shipped", "no deterministic key in the blocks", "exact features carry the score"])
def test_large_groups_meet_as_matrices(spark, name, monkeypatch):
    """Groups above the limit leave their tiles scored, smaller ones a join; every pair comes once."""
    monkeypatch.setattr(linkage, "TILE_ROWS", 6)
    monkeypatch.setattr(linkage, "RECURRING_ROWS", 30)
    records, spec = make(10, 130), CONFIGS[name]
    made, given = [], linkage._slot_pairs
    monkeypatch.setattr(linkage, "_slot_pairs", lambda *a: made.append(a[1].count()) or given(*a))
    truth = profile_pairs(brute(records, spec), records, spec, spec.review)
    for split in (5_000, 3):
        rows = linkage.fuzzy_pairs(frame(spark, records), spec, None, split).collect()
        assert {(r["record_uid_1"], r["record_uid_2"]): (r["record_pairs"], r["score"], r["decision"]) for r in rows} == truth
        assert len(rows) == len(truth)
    assert len(made) == 2 and all(made)


def test_tiles_of_long_and_odd_texts():
    """Matrices of texts of one machine word, of several and of none give what the measures give pair by pair, over groups of all sizes."""
    import pyarrow as pa
    from kinfold.functions import similarity as sim, tiles
    rng = random.Random(11)
    lcs_all, token_set_all = sim._measures()
    text = lambda: "".join(rng.choice("abc é\U0001F600") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 17, 33, 64, 65, 140])))
    groups = [[(f"{g}-{i}", " ".join(sorted(text().split())) if rng.random() < 0.9 else None, " ".join(dict.fromkeys(text().split())))
               for i in range(n)] for g, n in enumerate((2, 1, 30, 150, 3, 40, 100))]
    rows = [(u, a, b, f"{g}") for g, members in enumerate(groups) for u, a, b in members]
    same = len(rows)
    table = pa.table({
        "uid": [r[0] for r in rows], "n": pa.array([1] * same, pa.int64()), "__blocks": [[r[3]] for r in rows], "__block": [r[3] for r in rows],
        "__a": [r[1] for r in rows], "__b": [r[2] for r in rows], "__row": [0] * same, "__tile": [0] * same, "__side": [tiles.BOTH] * same,
        "__once": [True] * same})
    kernel = tiles.make_tiles([("a", "token_sort_ratio", 0.6), ("b", "token_set_ratio", 0.4)], [], (), 0.0)
    found = {(r["uid_1"], r["uid_2"]): (r["sim_a"], r["sim_b"]) for out in kernel(iter(table.to_batches(max_chunksize=37))) for r in out.to_pylist()}
    expected = {}
    for members in groups:
        for (u, a, b), (v, c, d) in itertools.combinations(members, 2):
            first = 0.0 if a is None or c is None else 1.0 if not a and not c else 2.0 * lcs_all([a], [c])[0] / (len(a) + len(c))
            expected[tuple(sorted((u, v)))] = (first, token_set_all([b], [d])[0])
    assert found == expected


def test_pair_features_carry_columns(spark):
    """Both records of a pair bring their own columns, so nothing is joined back to the pairs."""
    records = make(6, 60)
    tagged = frame(spark, records).withColumn("tag", F.concat(F.lit("t"), "record_uid"))
    rows = linkage.pair_features(tagged, CONFIGS["shipped"], 0.3, carried=("tag",)).collect()
    assert rows and all((r["tag_1"], r["tag_2"]) == ("t" + r["record_uid_1"], "t" + r["record_uid_2"]) for r in rows)


def test_scorer_counts_equal_pairs(spark):
    """The fit on counted rows is that of the single pairs, and stores one row per distinct row of similarities."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from kinfold.operators import evaluate
    rng, spec = random.Random(3), CONFIGS["shipped"]
    sims = [f"sim_{f.attribute}" for f in spec.features]
    kinds = [([rng.choice([0.0, 0.25, 0.5, 1.0]) for _ in sims], rng.random()) for _ in range(12)]
    rows = [(*k, rng.random() < p) for k, p in rng.choices(kinds, range(1, 13), k=500)]
    data = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in sims) + ", is_match boolean")
    model = evaluate.train_scorer(data, spec)
    assert model.stages[-1].getWeightCol() == "pairs"
    plain = VectorAssembler(inputCols=sims, outputCol="features").transform(data.withColumn("target", F.col("is_match").cast("double")))
    other = LogisticRegression(labelCol="target", regParam=0.01, maxIter=50).fit(plain).transform(plain)
    expected = {tuple(r[s] for s in sims): r["p"] for r in other.withColumn("p", vector_to_array("probability")[1]).collect()}
    for r in evaluate.apply_scorer(model, data).collect():
        assert r["match_probability"] == pytest.approx(expected[tuple(r[s] for s in sims)], abs=1e-4)


def test_kernels_on_long_and_odd_texts(spark):
    """Texts of one machine word and longer ones, in one batch, against the definitions."""
    from kinfold.functions import similarity as sim
    rng = random.Random(9)
    texts = ["", "a", *["".join(rng.choices("abcdé安 \U0001F600", k=n)).strip() for n in (7, 8, 9, 16, 17, 33, 63, 64, 65, 90)]]
    pairs = [(" ".join(a.split()), " ".join(b.split())) for a in texts for b in texts] + [(None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    found = df.select("a", "b", sim.make_kernel("lcs")("a", "b").alias("lcs"), sim.make_kernel("token_set")("a", "b").alias("set")).collect()
    for r in found:
        assert (r["lcs"], r["set"]) == ((None, None) if r["a"] is None else (lcs(r["a"], r["b"]), pytest.approx(token_set(r["a"], r["b"]))))


def test_component_rounds_run_on_numbers(spark, monkeypatch):
    """Texts are numbered once; the rounds and their stages hold numbers, the result holds the texts."""
    from kinfold.operators import components
    types, write = [], components.write_stage
    monkeypatch.setattr(components, "write_stage", lambda df, label="stage": types.append(df.dtypes) or write(df, label))
    edges = spark.createDataFrame([("a" * 64, "b"), ("b", "c"), ("c", "b"), ("d", "e"), ("f", "f")], "src string, dst string")
    found = {tuple(r) for r in components.connected_components(edges).collect()}
    assert found == {("a" * 64, "c"), ("b", "c"), ("c", "c"), ("d", "e"), ("e", "e")}
    assert types and all(kind == "bigint" for t in types for _, kind in t)


def test_recurring_texts_are_measured_once(spark, monkeypatch):
    """Few names in large groups: similarity is asked per pair of names and group, and the pairs equal brute force."""
    from kinfold.plans.entities import PART
    spec, rng = PART.matching, random.Random(3)
    columns = ["record_uid", "p_name", "p_brand", "p_type", "p_size"]
    pick = lambda values: rng.choice([*values, None])
    rows = [(f"{i:04d}", pick(["Red Bolt", "Bolt Red", "Red Bolts", "Rod", ""]), pick("AB"), pick("XY"), pick([str(n) for n in range(40)]))
            for i in range(400)]
    asked, ratio = spark.sparkContext.accumulator(0), linkage.sim.ratio

    def counting(method, a, b):
        seen = F.udf(lambda text: (asked.add(1), text)[1]).asNondeterministic()
        return ratio(method, seen(a), b)

    monkeypatch.setattr(linkage.sim, "ratio", counting)
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = {(r["record_uid_1"], r["record_uid_2"]): (r["record_pairs"], r["score"], r["decision"])
           for r in linkage.fuzzy_pairs(df, spec, split_rows=3).collect()}
    truth, records = {}, [dict(zip(columns, r)) for r in rows]
    for a, b in itertools.combinations(records, 2):
        same = {c: a[c] is not None and a[c] == b[c] for c in columns[1:]}
        if not same["p_brand"] and not (same["p_type"] and same["p_size"]):
            continue
        score = 0.2 * same["p_brand"] + 0.2 * same["p_type"] + 0.1 * same["p_size"]
        if a["p_name"] is not None and b["p_name"] is not None:
            score += 0.5 * token_sort(a["p_name"], b["p_name"])
        clash = a["p_type"] is not None and b["p_type"] is not None and not same["p_type"]
        score = round(score, 4)
        truth[a["record_uid"], b["record_uid"]] = (all(same.values()), score, "REJECTED_FP_GUARD" if clash else "MATCH" if score >= 0.85 else "REVIEW")
    expected = profile_pairs(truth, records, spec, spec.review)
    assert got == expected and len(got) > 1000
    assert 0 < asked.value < len(got) / 2
