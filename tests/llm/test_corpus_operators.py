"""Operators on whole corpora against brute force, with the hard rows of the fixture."""

import random
import shutil
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import compare
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from kinfold.llm import line_templates, mixing, near_duplicates, perfect_hash, queries, token_files, url_lists, vamana
from kinfold.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.spark_rows(queries.QUERIES[name](spark, SF)) == compare.sql_rows(compare.connect(SF), ORACLE[name])


def test_near_duplicates_equal_all_pairs(docs, rows, none):
    wanted = brute.components([(r[0], r[1]) for r in rows])
    clashing = docs.withColumn("tokens", F.lit(1)).withColumn("component_id", F.lit(2))
    got = near_duplicates.components(clashing.unionByName(clashing.filter("doc_id = 1"))).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*wanted[r.doc_id], wanted[r.doc_id][1] == r.doc_id)
    assert near_duplicates.components(none).count() == 0
    kept = near_duplicates.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, c) in wanted.items() if d == c}


def test_near_copies_that_their_centre_does_not_link(spark):
    """Members far from the centre but near each other, in every list of the centre."""
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 30):  # near the centre
        w = list(base)
        w[5 * k] = f"c{k}"
        rows.append((k, " ".join(w)))
    far = list(base)
    for i in range(3, 200, 18):
        far[i] = f"far{i}"
    for k in range(30, 36):  # not near the centre, near each other
        w = list(far)
        w[6 * k - 170] = f"f{k}"
        rows.append((k, " ".join(w)))
    wanted = brute.components(rows)
    assert len({c for _, c in wanted.values()}) > 1
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == wanted


def test_null_ids_are_never_the_smallest(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text), (7, text), (None, "x y z u v w"), (3, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates.components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 6, 7, True), (7, 6, 7, True), (None, 2, None, True), (3, 0, 3, True)}


def test_recurring_lines_equal_the_tree(docs, rows, none):
    wanted = brute.line_drops([(r[0], r[1]) for r in rows], line_templates.DEPTH, 1, line_templates.SIMILAR)
    clashing = docs.withColumn("lines", F.lit(1)).withColumn("doc", F.lit(2))
    cut = line_templates.dedup(clashing.unionByName(clashing.filter("doc_id = 4")))
    assert cut.columns == clashing.columns and cut.count() == len(rows) + 1
    for r in cut.collect():
        source = next(x for x in rows if x[0] == r.doc_id)
        assert r.text == (None if source[1] is None else wanted[r.doc_id]), r.doc_id
    assert line_templates.report(none).count() == 0


def test_variable_fields_are_generalised(spark):
    line = "session {} opened for user {} from host {} at the front door today"
    rows = [(k, f"own words of document {k} " + "abcdefgh"[k] * 3 + "\n" + line.format(k * 7, "abcdefgh"[k], k)) for k in range(8)]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_templates.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (2, 0) and all(got[k][1] >= 1 for k in range(1, 8))


def test_short_lines_recur_by_their_exact_words(spark):
    texts = ["All rights reserved.\nPage 1\n\nLes.\nown line of one", "All  rights reserved.\nPage 2\n\nLes.", "Les.\n \nall rights reserved."]
    got = line_templates.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_dropped, r.text) for r in got} == {
        0: (0, texts[0]), 1: (2, "Page 2\n"), 2: (1, " \nall rights reserved.")}


def test_lines_that_share_only_their_leading_words_stay(spark):
    lines = [f"you can also buy {w}" for w in ("apples", "pears", "bread")]
    lines += ["1 2 3 4 5 6 7 8 9 10", "1 2 3 4 5 6 7 8 9 11", "10 20 30 40 50 60 70 80 90 100"]
    lines += [f"{k} {k} {k} {k} {k} {k} {k} {k} {k} {w}" for k, w in enumerate(("salt", "milk"))]
    got = line_templates.report(spark.createDataFrame(list(enumerate([*lines, lines[0], lines[3]])), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {k: int(k >= len(lines)) for k in range(len(lines) + 2)}


@pytest.mark.parametrize("weights", [(4, 4), (7, 3, 2)])
def test_a_leaf_holds_several_templates(spark, weights):
    names = "abcdefgh"
    lines = [(m, "the same first words " + " ".join(names[m] + c for c in "klmno") + f" {names[k]} " + " ".join(names[m] + c for c in "pqrst"))
             for k in range(max(weights)) for m, n in enumerate(weights) if k < n]
    got = line_templates.report(spark.createDataFrame([(k, x) for k, (_, x) in enumerate(lines)], "doc_id long, text string")).collect()
    first = {m: min(k for k, (x, _) in enumerate(lines) if x == m) for m in range(len(weights))}
    assert {r.doc_id: r.n_dropped for r in got} == {k: int(k != first[m]) for k, (m, _) in enumerate(lines)}


def test_mixture_meets_targets_and_limits(spark, docs, rows, none):
    clashing = docs.withColumn("row", F.lit(1)).withColumn("copies", F.lit(9))
    got = mixing.report(clashing).collect()
    again = {(r.doc_id, r.taken) for r in mixing.report(clashing.repartition(7)).collect()}
    assert {(r.doc_id, r.taken) for r in got} == again and len(got) == len(rows)
    sizes, source = defaultdict(int), {r[0]: r[3] for r in rows}
    for r in got:
        assert r["size"] == len(brute.words(next(x[1] for x in rows if x[0] == r.doc_id)))
        assert r.taken in {k * r["size"] for k in range(4)}
        sizes[source[r.doc_id]] += r["size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = dict(zip(order, (5, 2, 1) * 3))
    target, full = {}, set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in sizes if s not in full)
        above = {s for s in sizes if s not in full and weight[s] * level > 3 * sizes[s]}
        if not above:
            break
        full |= above
    target = {s: float(3 * sizes[s]) if s in full else weight[s] * level for s in sizes}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    # One very long text cannot be split; every other source is met closely.
    assert all(abs(taken[s] - target[s]) <= max(60, 0.02 * target[s]) for s in sizes if sizes[s] < 20000)
    mixed = mixing.mixture(clashing)
    assert mixed.columns == clashing.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert mixing.report(none).count() == mixing.mixture(none).count() == 0


def test_rates_solve_the_dual(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 40)), "abc"[k % 3]) for k in range(900)]
    got = mixing.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.target].append(r)
    for target, some in by.items():
        assert sum(r.rate * r["size"] for r in some) == pytest.approx(target, rel=1e-6)
        assert abs(sum(r.taken for r in some) - target) <= 0.005 * target


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.random.default_rng(1).integers(-2**62, 2**62, 5000)
    levels = perfect_hash.build(keys)
    assert sorted(perfect_hash.slots(levels, keys)) == list(range(5000))
    assert perfect_hash.build(np.zeros(0, np.int64)) == []
    with pytest.raises(ValueError):
        perfect_hash.build(np.array([3, 3]))


def test_token_pieces_are_words_lines_and_marks():
    """Lines and marks make no pieces of their own with the words beside them, and ids are the library's on odd texts."""
    texts = pa.array(["one two.\nThree two, two...", "one two\n\nthree  four", "", "\nx"], pa.large_string())
    distinct, codes, rows = token_files.pieces(texts)
    assert [[distinct[c].as_py() for c in codes[rows == r]] for r in range(4)] == [
        ["one", " two.", "\nThree", " two,", " two..."], ["one", " two\n\nthree  four"], [""], ["\nx"]]
    encoder = token_files.PieceEncoder(token_files.TOKENIZER, "<u2")
    encoder.ids(distinct)
    assert {" two", ",", ".", "..."} <= set(encoder.seen.to_pylist()) and not {" two.", " two,", " two..."} & set(encoder.seen.to_pylist())
    rng, library = random.Random(8), Tokenizer.from_file(token_files.TOKENIZER)
    odd = ["".join(rng.choice([" ", "\n", " ", "\n", "\t", "\xa0", "\x1c", "\x0b", ".", ",", "?!", "'s", "'", "a", "The", "é", "ß", "\u01c5", "\u0301", "×", "9", "日",
                               "<|endoftext|>", "\U0001F600", "&&&"]) for _ in range(rng.randrange(40))) for _ in range(3000)]
    odd += [f"{a}\n{b} {c}" for a, b, c in zip(odd, odd[1:], odd[2:])]
    for _ in range(2):  # the second time from what is remembered
        got = [i.tolist() for i in token_files.encoded(pa.array(odd), token_files.TOKENIZER, "<u2", 0)]
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in odd]


def test_token_files_read_back_whole(spark, docs, rows, none, tmp_path):
    library = Tokenizer.from_file(token_files.TOKENIZER)
    extra = [(900 + n, t) for n, t in enumerate([" lead", "trail ", "a  b\n\n c \n d", "x<|endoftext|> y", "a\xa0 b", "\n", "it's 12 34"])]
    texts = [*[(r[0], r[1]) for r in rows], *extra, (900, "again"), (None, "no id")]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("shard", F.lit(1))
    path = str(tmp_path / "files")
    got = sorted(token_files.report(table, path).collect(), key=lambda r: r.start)
    assert len(got) == len(texts) and [r.doc_id for r in got] == sorted((t[0] for t in texts), key=lambda d: -1 if d is None else d)
    ids = {d: [] for d, _ in texts}
    for d, t in texts:
        ids[d].append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    at = 0
    for r in got:
        assert r.start == at
        sums = {zlib.crc32(np.array(i, "<u4").tobytes()): len(i) for i in ids[r.doc_id]}
        assert sums[r.ids_crc32] == r.n_tokens
        at += r.n_tokens
    asked = spark.createDataFrame([(5,), (5,), (12345,), (None,)], "key long")
    found = token_files.lookup(spark, path, asked).collect()
    assert [(r.key, r.length) for r in found] == [(5, len(ids[5][0]))]
    read = {r.key: r for r in token_files.fetch(spark, path, asked).collect()}
    assert set(read) == {5} and np.frombuffer(read[5].ids, "<u4").tolist() == ids[5][0]
    # Rows come from where the index points: with every offset at 0, only the documents that begin a chunk are found.
    wrong = str(tmp_path / "wrong")
    for part in ("chunks", "shards"):
        shutil.copytree(f"{path}/{part}", f"{wrong}/{part}")
    index = token_files.read_index(spark, path).withColumn("offsets", F.expr("cast(repeat('\\0', octet_length(offsets)) AS binary)"))
    index.write.partitionBy("part").parquet(f"{wrong}/index")
    begin = {r.key for r in token_files.entries(token_files.read_chunks(spark, path)).filter("offset = 0").collect()} - {None}
    everyone = spark.createDataFrame([(d,) for d in ids], "key long")
    assert {r.key for r in token_files.fetch(spark, wrong, everyone).collect()} == begin < set(ids)
    assert token_files.report(none, str(tmp_path / "empty")).count() == 0


def test_graph_search_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 12)).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(600 + i, points[100].tolist()) for i in range(30)]  # one vector many times
    rows += [(700, None), (800, [0.0] * 12), (900, [float("nan")] * 12), (1000, [1.0, None] + [0.0] * 10), (1100, []),
             (1200, [1.0, 2.0]), (1300, [1.0, 3.0]), (None, points[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1))
    got = defaultdict(list)
    for r in vamana.report(table.unionByName(table.filter("vec_id = 300"))).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 300, 400, 500, 600, 1200, 1300}
    usable = {i: np.array(v, float) for i, v in rows if i is not None and i < 700}
    hit = 0
    for q in (0, 100, 200, 300, 400, 500, 600):
        exact = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q)[:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[2] for m in mine] == sorted(m[2] for m in mine)
        hit += len({i for _, i in exact} & {m[1] for m in mine})
        if q in (100, 600):
            assert [m[1] for m in mine] == [i for _, i in exact]
    assert hit >= 0.9 * 70
    assert [(m[1]) for m in got[1200]] == [1300]
    assert vamana.report(table.filter("false")).count() == 0


def test_url_entries_hold_as_of_the_fetch(spark):
    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    log = [("bad", "evil.org", "add", day(1)), ("bad", "evil.org", "remove", day(100)), ("bad", "evil.org", "add", day(200)),
           ("bad", "a.example.com/x/y", "add", day(0)), ("ads", "evil.org", "add", day(50)), ("ads", "evil.org", "remove", day(50)),
           ("bad", None, "add", day(0)), (None, "evil.org", "add", day(0))]
    captures = [(1, "http://www.EVIL.org:80/p?q", day(0)), (2, "http://www.evil.org/", day(1)), (3, "https://u@evil.org", day(99)),
                (4, "http://evil.org/", day(100)), (5, "http://evil.org/", day(5000)), (6, "http://a.example.com/x/y/z", day(3)),
                (7, "http://a.example.com/x/yy", day(3)), (8, None, day(3)), (9, "not a url", day(3)), (10, "http://evil.org/", None),
                (2, "http://www.evil.org/", day(1)), (11, "http://notevil.org/", day(5))]
    got = url_lists.verdicts(spark.createDataFrame(captures, "capture long, url string, fetched_at timestamp").withColumn("key", F.lit(1)),
                             spark.createDataFrame(log, "list string, key string, action string, at timestamp")).collect()
    assert sorted((r.capture, r.n_active) for r in got) == [
        (1, 0), (2, 1), (2, 1), (3, 1), (4, 0), (5, 1), (6, 1), (7, 0), (8, 0), (9, 0), (10, 0), (11, 0)]
    assert all(r.allowed == (r.n_active == 0) for r in got)
    nobody = spark.createDataFrame([], "capture long, url string, fetched_at timestamp")
    assert url_lists.verdicts(nobody, spark.createDataFrame(log, "list string, key string, action string, at timestamp")).count() == 0
