"""Hard negatives, the n-gram Jaccard join and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from kinfold.llm import hard_negatives, spelling, token_groups

VECTORS = "vec_id long, embedding array<float>, label int"


# Hard negatives

def mined(rows):
    """The contract of the query, anchor by anchor over all rows."""
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable[vec_id] = (label, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
    out = set()
    for a, (label, v) in usable.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in usable.items() if i != a and len(w) == len(v))
        for s, p, other in [x for x in scored if x[2] == label][:5]:
            inside = [(n, t) for t, n, o in scored if o != label and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out |= {(a, p, k + 1, n, -s, -t) for k, (n, t) in enumerate(inside)}
    return out


def answers(df):
    got = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got))
    return set(got)


def hard_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 6).round(1).tolist(), int(rng.integers(0, 3))) for i in range(400)]  # rounded: many ties
    rows += [(1000 + i, [0.5, 0.1, 0.0, -0.2, 0.3, 0.1], 1) for i in range(150)]  # copies of one vector
    rows += [(2000, [0.0] * 6, 1), (2001, None, 1), (2002, [0.1] * 6, None), (2003, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1),
             (2004, [float("nan")] * 6, 1), (2005, [float("inf")] + [0.1] * 5, 1), (2050, [0.4, 0.2], 0), (2051, [0.5, 0.2], 0),
             (2052, [0.3, 0.2], 2), (2053, [0.2, 0.2], 2), (2100, [], 1), (2101, [], 2), (2102, [], 1), (None, [0.9] * 6, 1), (-50, [0.3] * 6, 2)]
    return rows


def test_hard_negatives_equal_all_scores(spark, monkeypatch):
    rows = hard_rows()
    wanted = mined(rows)
    assert len(wanted) > 60 and any(r[5] == 0 for r in wanted)
    df = spark.createDataFrame(rows + rows[:60], VECTORS).selectExpr("*", "1 AS rank", "'x' AS shard", "2 AS score", "3 AS vector")
    assert answers(hard_negatives.report(df)) == wanted
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 4)
    assert answers(hard_negatives.report(df)) == wanted


def test_hard_negatives_of_nothing_and_of_too_much(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.report(none).count() == 0
    huge = spark.createDataFrame([(50, [3e38, 1.0], 1), (1, [1.0, 1.0], 1)], VECTORS)
    with pytest.raises(Exception, match="too long for integer scores"):
        hard_negatives.report(huge).count()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 8), st.sampled_from([3, 50, 40_000, 2**24]))
def test_threshold_search_meets_every_row_that_matters(seed, n, dims, reach):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-reach, reach, (n, dims))
    anchor = rng.integers(-reach, reach, dims)
    lists = hard_negatives.Lists(rows)
    scores = rows @ anchor
    for k in (1, 3):
        met, got = hard_negatives.threshold_search(
            lists, anchor, lambda r, s: -np.inf if len(s) < k else np.partition(s, len(s) - k)[len(s) - k])
        assert (got == scores[met]).all() and len(set(met.tolist())) == len(met)
        kth = sorted(scores.tolist())[-min(k, n)]
        assert set(np.flatnonzero(scores >= kth).tolist()) <= set(met.tolist())  # all ties of the kth included


def test_threshold_search_stops_early_where_scores_are_spread():
    rng = np.random.default_rng(1)
    rows = rng.pareto(1.0, (20_000, 4)).clip(0, 1000).astype(np.int64) * 10
    lists = hard_negatives.Lists(rows)
    met, scores = hard_negatives.threshold_search(
        lists, np.array([3, 1, 0, 2]), lambda r, s: -np.inf if len(s) < 3 else np.sort(s)[-3])
    assert len(met) < 2_000
    assert np.sort(scores)[-3:].tolist() == np.sort(rows @ np.array([3, 1, 0, 2]))[-3:].tolist()


# N-gram Jaccard join

def joined(rows, width=3, percent=90):
    sets = {}
    for d, text in rows:
        w = brute.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and (
        100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))]
    for _ in sets:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return {d: (len(s), label[d]) for d, s in sets.items()}


def test_join_equals_all_pairs(docs, rows, none):
    clashing = docs.selectExpr("*", "1 AS node", "2 AS tokens", "3 AS component_id", "4 AS `group`", "5 AS label")
    got = token_groups.components(clashing.unionByName(clashing.filter("doc_id = 1"))).collect()
    assert len(got) == len(rows) + 1
    wanted = joined([(r[0], r[1]) for r in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert token_groups.components(none).count() == 0


def copies(seed):
    """Chains and stars of near copies on both sides of the threshold, of short and long texts, behind shared passages."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(3000))
    texts = []
    passage = [word() for _ in range(60)]
    for length in (9, 10, 12, 19, 25, 60, 200, 700):
        for _ in range(3):
            base = [word() for _ in range(length)]
            if rng.random() < 0.4:
                base = passage + base
            texts.append(list(base))
            for _ in range(rng.randrange(2, 14)):
                new = list(rng.choice(texts[-4:]) if rng.random() < 0.3 else base)
                for _ in range(rng.randrange(0, 1 + len(new) // 40 + 1)):
                    at = rng.randrange(len(new))
                    kind = rng.randrange(3)
                    new[at:at + 1] = [] if kind == 0 else [word()] if kind == 1 else [new[at], word()]
                texts.append(new)
    return [(i * 3 % 1009, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1])
def test_join_of_near_copies_equals_all_pairs(spark, seed, monkeypatch):
    rows = copies(seed)
    wanted = joined(rows)
    sizes = Counter(c for _, c in wanted.values())
    assert len(sizes) > 30 and max(sizes.values()) > 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(token_groups, "GROUP", 3)  # small groups: links between groups must be found
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in token_groups.components(df).collect()}
    assert got == wanted


def test_a_group_too_large_for_one_is_joined_by_the_matrix(spark, monkeypatch):
    """300 near copies, half of them too far from each other to link; one task sees a few at a time."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(300):
        new = list(base)
        for i in range(1 if k % 2 else 3):
            new[rng.randrange(120)] = f"own{k}_{i}"
        rows.append((k, " ".join(new)))
    monkeypatch.setattr(token_groups, "GROUP", 8)
    monkeypatch.setattr(token_groups, "BLOCK_TOKENS", 500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in token_groups.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == joined(rows)


def test_near_copies_that_do_not_link_probe_no_groups(spark, monkeypatch):
    """120 copies with 9 own words in 300 words each, too far from each other; with the links of the others all found."""
    rng = random.Random(10)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for k in range(120):
        new = list(base)
        for i in rng.sample(range(0, 300, 5), 9):
            new[i] = f"own{k}_{i}"
        rows += [(k, " ".join(new)), *([(1000 + k, " ".join([*new[:-1], f"end{k}"]))] if k % 10 == 0 else [])]
    probed, inner = [], token_groups.candidates

    def watched(*frames):
        found = inner(*frames)
        probed.append(found.count())
        return found
    monkeypatch.setattr(token_groups, "GROUP", 8)
    monkeypatch.setattr(token_groups, "candidates", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in token_groups.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == joined(rows) and got[1010][1] == 10
    assert probed[0] <= len(rows)  # 16 groups each without the new prefixes


def test_groups_of_the_matrix_are_full_however_many_partitions(spark, monkeypatch):
    """200 near copies sorted in 50 partitions: 25 groups of 8 and no more, so a query meets no more of them."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(200):
        new = list(base)
        for i in range(2):
            new[rng.randrange(120)] = f"edit{rng.randrange(40)}_{i}"
        rows.append((k, " ".join(new)))
    sizes, inner = [], token_groups.matrix

    def watched(grouped):
        sizes.extend((r["class"], r["count"]) for r in grouped.groupBy("class", "group").count().collect())
        return inner(grouped)
    monkeypatch.setattr(token_groups, "GROUP", 8)
    monkeypatch.setattr(token_groups, "matrix", watched)
    settings_ = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in token_groups.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == joined(rows)
    assert len(sizes) > 3 and max(n for _, n in sizes) == 8
    for klass in {c for c, _ in sizes}:
        assert sum(n < 8 for c, n in sizes if c == klass) <= 1


def test_null_ids_in_the_join(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text), (7, text), (None, "x y z u v w"), (3, None), (4, "x y"), (5, "X Y")]
    got = {tuple(r) for r in token_groups.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 8, 7), (7, 8, 7), (None, 4, None), (3, 0, 3), (4, 1, 4), (5, 1, 4)}


# Spelling variants

def spelled(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes = defaultdict(set)  # words with one code point left out, or replaced by a blank
    for w in counts:
        for i in range(len(w)):
            holes[w[:i] + " " + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1:]) in counts:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def letters(seed, n_words=400, docs=120):
    rng = random.Random(seed)
    alphabet = "aabbccdeeéÀ÷z"
    vocab = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 9))) for _ in range(n_words)]
    vocab += ["aaaaaa", "aaaaa", "aaaaaaaa", "ababab", "bababa", "abababa"]
    texts = []
    for i in range(docs):
        some = rng.choices(vocab, [1 / (k + 1) for k in range(len(vocab))], k=150)
        for k in range(0, len(some), 9):
            w = some[k]
            at = rng.randrange(len(w))
            some[k] = w[:at] + rng.choice(["", "a", "z" + w[at]]) + w[at + 1:]
        texts.append((i, rng.choice([" ", "-", "1", "ÿ ", "漢"]).join(w.upper() if rng.random() < 0.1 else w for w in some)))
    return texts


def test_spellings_equal_all_pairs(spark, docs, rows, none):
    texts = letters(4) + [(None, "banane bananes"), (500, None), (501, ""), (502, "banane bananes banana İstanbul"), (503, "Banane BANANES banana")]
    texts += [(504, ("abcde " * 300_000) + "漢" * 10)]  # longer than a piece
    wanted = spelled(texts)
    assert sum(v[0] is not None for v in wanted.values()) > 30 and any(v[1] != v[0] for v in wanted.values() if v[0])
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS word", "2 AS n", "3 AS form")
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.report(df).collect()} == wanted
    assert spelling.report(none).count() == 0
    some = spelling.report(docs.unionByName(docs)).collect()  # repeated rows count again
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in some} == spelled([(r[0], r[1]) for r in rows] * 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), min_size=3, max_size=12, unique_by=lambda x: x[0]))
def test_pivots_are_the_cheapest_disjoint_pair(prefix):
    count = dict(prefix)
    pairs = [(a, b) for a in count for b in count if a + 2 <= b]
    if pairs:
        a, b = spelling.pivots(prefix)
        assert a + 2 <= b and count[a] + count[b] == min(count[x] + count[y] for x, y in pairs)


def test_near_words_of_a_dense_vocabulary(spark):
    """All words over three letters of length 5 and some of 6: every bigram is common."""
    from itertools import product
    vocab = ["".join(p) for p in product("abc", repeat=5)] + ["".join(p) for p in product("ab", repeat=6)]
    got = {(r.a, r.b) for r in spelling.near_words(spark.createDataFrame([(w,) for w in vocab], "word string")).collect()}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    assert got == {(a, b) for a in vocab for b in vocab if a < b and near(a, b)}
