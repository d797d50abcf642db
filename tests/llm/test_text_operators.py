"""Operators on single texts: exact answers, nulls, empty and long texts, repeats, clashing columns, empty tables."""

import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from kinfold.llm import bpe, quality_rules, secrets, word_pieces


def test_quality_counts_equal_plain_python(docs, rows):
    got = {r.doc_id: r for r in quality_rules.report(docs).collect()}
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(text), doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_divergence_equals_its_definition(docs, rows):
    features = {r[0]: f for r, f in zip(rows, quality_rules.measure(pa.array([r[1] for r in rows], pa.string())).to_pylist())}
    refs = {}
    for doc_id, text, lang, *_ in rows:
        n, _, _, _, repeat = brute.quality(text)
        if n >= quality_rules.GUARD_WORDS and 100 * repeat <= 50 * n:
            ref = refs.setdefault(lang, {"chars": 0, "common": 0})
            for h in ref:
                ref[h] = ref[h] + np.array(features[doc_id][h], float)

    def distance(h, ref):
        p, q = (np.array(x, float) / np.sum(x) for x in (h, ref))
        m = (p + q) / 2
        kl = lambda a: np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0]))
        return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5
    for r in quality_rules.report(docs).collect():
        lang = next(x[2] for x in rows if x[0] == r.doc_id)
        if r.n_words and lang in refs:
            assert r.char_distance == pytest.approx(distance(features[r.doc_id]["chars"], refs[lang]["chars"]), abs=1e-9)
            assert r.word_distance == pytest.approx(distance(features[r.doc_id]["common"], refs[lang]["common"]), abs=1e-9)


def test_quality_judge_passes_all_columns_and_repeats(spark, docs, none, rows):
    clashing = docs.withColumn("f", F.lit(1)).withColumn("v", F.lit(2)).withColumn("ref_lang", F.lit("x"))
    kept = quality_rules.judge(clashing.unionByName(clashing))
    assert kept.columns == clashing.columns
    wanted = {r.doc_id for r in quality_rules.report(docs.unionByName(docs)).filter("kept").collect()}
    found = [r.doc_id for r in kept.collect()]
    assert sorted(found) == sorted([*wanted, *wanted]) and wanted
    assert quality_rules.judge(none).count() == quality_rules.report(none).count() == 0


def _labelled_corpus():
    """40 clean texts, one junk text that the base rules let pass, and near copies of it."""
    rng = random.Random(11)
    prose = lambda n: " ".join(rng.choice(("the", "of", "and", "house", "river", "green", "walks", "slowly", "in", "paper")) + rng.choice("abcdefgh") * rng.randrange(3)
                               for _ in range(n))
    junk = [f"{rng.randrange(10**9)}#%&" for _ in range(150)]
    near = [" ".join([*junk[:k], f"{k}#%&", *junk[k + 1:]]) for k in range(60)]
    return [prose(150 + 5 * k) for k in range(40)], " ".join(junk), near


@pytest.mark.parametrize("kind", ["copies", "near copies"])
def test_quality_reference_does_not_follow_copies_of_junk(spark, kind):
    good, junk, near = _labelled_corpus()
    bad = [junk] * 60 if kind == "copies" else near
    rows = [(k, t, "en") for k, t in enumerate(good)] + [(100 + k, t, "en") for k, t in enumerate(bad)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert {r.doc_id for r in quality_rules.report(table).filter("kept").collect()} == set(range(40))
    assert {r.doc_id for r in quality_rules.judge(table).collect()} == set(range(40))


def test_quality_judges_every_length_that_passes_the_base_rules(spark):
    good, junk, _ = _labelled_corpus()
    short = [" ".join(junk.split(" ")[:n]) for n in (50, 60, 99)]
    clean = [" ".join(t.split(" ")[:n]) for t, n in zip(good, (50, 60, 99))]
    rows = [(k, t, "en") for k, t in enumerate([*good, *clean, *short])]
    got = quality_rules.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} == set(range(43))


def test_secrets_equal_plain_python(docs, rows):
    got = {r.doc_id: r for r in secrets.digest(secrets.findings(docs, path="doc_id")).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        base = brute.secrets(text)
        assert got[doc_id].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), doc_id
        assert [got[doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
    assert sum(r.n_assign for r in got.values()) >= 4


def test_secret_ledger_scans_only_unseen_blobs(spark, tmp_path, none):
    first = spark.createDataFrame([("p1", "token=abcdefgh"), ("p2", "token=abcdefgh"), (None, None)], "path string, text string")
    more = first.unionByName(spark.createDataFrame([("p1", "AKIA" + "Z" * 20), ("p1", "token=abcdefgh")], "path string, text string"))
    ledger = str(tmp_path / "ledger")
    assert secrets.findings(first, ledger).count() == 3
    assert spark.read.parquet(ledger).count() == 2
    assert secrets.findings(more, ledger).count() == 5  # a repeated row is returned twice
    assert spark.read.parquet(ledger).count() == 3
    named = secrets.addressed(more, "path", "text")
    assert secrets.unseen(named, secrets.read_ledger(spark, ledger), secrets.rule_version()).count() == 0
    changed = secrets.RULES[:2]
    assert secrets.findings(more, ledger, rules=changed).count() == 5
    assert spark.read.parquet(ledger).count() == 6  # another rule version scans every blob anew
    assert secrets.findings(none, str(tmp_path / "other"), path="doc_id").count() == 0


def test_added_secret_rules_come_on_top():
    text = "-----BEGIN RSA PRIVATE KEY----- token=abcdefgh"
    assert [s["kind"] for s in secrets.spans_of(text)] == ["pem", "assign"]


def odd_texts():
    rng = random.Random(2)
    odd = ["", "  ", "İstanbul ΣΑΣ", "x<|endoftext|>y <|startoftext|>", "½ ² ª", "don't I'LL", "a\x1cb\x85c\xa0d",
           "日本語 テスト 12", "é ﬁ", "\U0001F600!!", "a" * 3000, "ab" * 1500 + "!", "\x00\x7f"]
    odd += ["".join(map(chr, range(a, a + 16))) for a in range(0, 0x400, 16)]
    return odd + [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 15))) for _ in range(80)) for _ in range(40)]


def test_bpe_equals_the_library_and_decodes_alike(spark, docs, rows, none):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    texts = [*odd_texts(), *[r[1] for r in rows]]
    numbered = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: r for r in bpe.report(numbered).collect()}
    for n, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[n].n_tokens == len(ids), repr(text)[:60]
        assert got[n].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), repr(text)[:60]
        assert got[n].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.report(none).count() == 0


def test_bpe_encodes_a_text_once(spark, docs):
    """No second call of Python for the decoded text, which would encode every text again."""
    import corpus_pipeline
    for df in (bpe.report(docs), corpus_pipeline.bpe_stage(spark, docs, "")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "pythonUDF0" in plan and "pythonUDF1" not in plan


def test_bpe_verification_only_passes_what_exact_merging_gives():
    one = bpe.loaded(bpe.TOKENIZER)
    distinct = sorted({p for t in odd_texts() for w in t.split() for p in one.pretokens(w) if p not in one.special})
    proposals = [one.proposed(p) for p in distinct]
    good = one.verified(proposals)
    exact = [one.merged(one.symbols(p)) for p in distinct]
    assert all(p == e for p, e, ok in zip(proposals, exact, good) if ok) and 0 < good.sum() < len(good)


def test_word_pieces_equal_greedy_longest_match(spark, docs, rows, none):
    with open(word_pieces.TOKENIZER, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    symbols = bpe.byte_symbols()
    longest = max(map(len, vocab))

    def greedy(word):
        held, n = word_pieces.SPACE + "".join(symbols[b] for b in word.encode()), 0
        while held:
            held = held[next(k for k in range(min(longest, len(held)), 0, -1) if held[:k] in vocab):]
            n += 1
        return n
    texts = {**{r[0]: r[1] for r in rows}, **{1000 + n: t for n, t in enumerate(odd_texts())}}
    numbered = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("n", F.lit(0))
    for r in word_pieces.report(numbered).collect():
        w = brute.words(texts[r.doc_id])
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(w), sum(map(greedy, w)), 0)
    assert word_pieces.report(none).count() == 0


def test_word_piece_automaton_knows_uncovered_words():
    automaton = word_pieces.Automaton(["ab", "abc", "x"], ["d", "de", "c"], False)
    assert [automaton.count(w) for w in ("ab", "abc", "abd", "abcde", "xcdde", "abce", "q", "a")] == [1, 1, 2, 2, 4, 0, 0, 0]


def test_full_caches_change_nothing(monkeypatch):
    from kinfold.llm import token_files

    for module, name in ((bpe, "CACHE_WORDS"), (token_files, "CACHE_PIECES"), (word_pieces, "CACHE_WORDS")):
        monkeypatch.setattr(module, name, 5)
    texts = pa.array(odd_texts())
    words, pieces = Tokenizer.from_file(bpe.TOKENIZER), Tokenizer.from_file(token_files.TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in bpe.encoded(texts, bpe.TOKENIZER).to_pylist()] == [
            words.encode(t, add_special_tokens=False).ids for t in odd_texts()]
        assert [i.tolist() for i in token_files.encoded(texts, token_files.TOKENIZER, "<u2", 0)] == [
            [*pieces.encode(t, add_special_tokens=False).ids, 0] for t in odd_texts()]


def test_line_templates_read_a_text_once(spark):
    """Other white space is normalized as before; no line carries its text, and a cut text is split once."""
    from kinfold.llm import line_templates
    rows = [(1, "red  fox\tran over the hill\nown one"), (2, " red fox ran\vover the hill \nown two"), (3, None), (4, "red fox ran over the hill")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in line_templates.report(docs).collect()}
    assert kept == {1: rows[0][1], 2: "own two", 3: None, 4: ""}
    plan = line_templates.parsed(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    carried = plan[plan.index("Generate posexplode"):].split("-1)), [")[1].split("]")[0]
    assert "doc#" in carried and "text#" not in carried
    plan = line_templates.dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(split(" not in plan and "element_at(every" in plan


def test_minhash_sets_leave_slice_by_slice(monkeypatch):
    """The sets of one slice of a batch are gone before the next slice is read; the columns are as from whole batches."""
    import weakref

    import numpy as np
    import pyarrow as pa

    from kinfold.llm import near_duplicates
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(20)] + ["", None, "one two"])
    expected = near_duplicates.shingle_sets(texts.cast(pa.large_string()).fill_null(""))
    made, inner = [], near_duplicates.shingle_sets

    def watched(some):
        assert not any(ref() is not None for ref in made)
        sets = inner(some)
        made.extend(weakref.ref(s) for s in sets)
        return sets

    monkeypatch.setattr(near_duplicates, "shingle_sets", watched)
    got = near_duplicates._sets(texts)
    assert [np.array(s, np.int64).view(np.uint64).tolist() for s in got.field("shingles").to_pylist()] == [s.tolist() for s in expected]
    assert [sum(p) for p in got.field("parts").to_pylist()] == [len(s) for s in expected]
    assert got.field("high").to_pylist() == [near_duplicates._fingerprint(s)[0] for s in expected]
    assert len(near_duplicates._sets(texts[:0])) == 0 and len(made) == len(expected)
