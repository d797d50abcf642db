"""Rows that once got wrong answers."""

from datetime import datetime

from pyspark.sql import functions as F

from kinfold.llm import line_templates, near_duplicates, quality_rules, url_lists


def test_near_duplicates_are_judged_by_row(spark):
    x, y = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(3, y, "p"), (5, x, "q"), (5, y, "r"), (7, x, "s"), (8, x, "t"), (8, x, "t"), (None, x, "u"), (9, None, "v"), (9, "", "w"), (9, "", "w"),
            (11, "k2 l m n o p q", "1"), (11, "k2 l m n o p q", "2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, md5 string")
    kept = sorted(((r.doc_id, r.text) for r in near_duplicates.keep_one(docs).collect()), key=str)
    assert kept == sorted([(3, y), (5, x), (9, None), (9, ""), (9, ""), (11, "k2 l m n o p q")], key=str)


def test_near_copies_under_one_id(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join([*words[:-1], "z"])), (1, "some other text of its own"), (None, " ".join(words))]
    kept = near_duplicates.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {1} and "some other text of its own" in {r.text for r in kept}


def test_a_capture_id_with_two_urls(spark):
    at = datetime(2024, 5, 1)
    captures = spark.createDataFrame([(1, "http://bad.org/", at), (1, "http://good.org/", at), (1, "http://good.org/", at), (None, "http://bad.org/", at)],
                                     "capture long, url string, fetched_at timestamp")
    log = spark.createDataFrame([("l", "bad.org", "add", datetime(2024, 1, 1))], "list string, key string, action string, at timestamp")
    got = sorted(((r.host, r.allowed, r.n_active) for r in url_lists.verdicts(captures, log).collect()))
    assert got == [("bad.org", False, 1), ("bad.org", False, 1), ("good.org", True, 0), ("good.org", True, 0)]


def test_lines_that_share_only_their_leading_words_stay(spark):
    lead = "these four leading words "
    lines = ["qbieagd qbccjed qbafhdi qbbgbg qbacadc", "qdgiedg qiejhe qgiici qiggdi qhcbhc"]
    rows = [(k, f"own{k} {'abcdefgh'[k]} text of its own here\n" + lead + lines[k % 2]) for k in range(2)]
    cut = line_templates.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in cut.collect()} == dict(rows)


def test_quality_stage_measures_texts_once(spark, docs):
    plan = quality_rules.judge(docs.select("text", "lang", F.lit(1).alias("f")))
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.columns == ["text", "lang", "f"]
