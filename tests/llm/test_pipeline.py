"""The pipeline stage by stage against brute force on the stage's own input."""

import hashlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from kinfold.llm import bpe, line_templates, mixing, quality_rules


def test_line_stage_removes_exact_copies_with_short_lines(spark, docs):
    text = "Haanth.\n\n" + "\n".join(f"line {w} of a text that has a copy in the corpus" for w in ("one", "two", "three"))
    rows = [(1, text, "en", "a", 0), (2, text, "fr", "b", 0), (3, "nothing in common", "en", "a", 0), (4, "\n", "en", "a", 0)]
    left = corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, docs.schema), "").collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 4]


def test_stages_on_their_own_input(spark, docs, none):
    frame = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = frame.collect()
        frame = corpus_pipeline.materialize(stage(spark, frame, ""), f"test-{k}")
        after = frame.collect()
        if k < 4:
            assert frame.columns == docs.columns
        texts = [(r.doc_id, r.text) for r in before]
        if k == 0:
            verdict = {r.doc_id for r in quality_rules.report(docs).filter("kept").collect()}
            assert {r.doc_id for r in after} == verdict and 0 < len(after) < len(before)
        if k == 1:
            wanted = brute.line_drops(texts, line_templates.DEPTH, 1, line_templates.SIMILAR)
            assert {r.doc_id: r.text for r in after} == {d: t for d, t in wanted.items() if t}
            assert all(r.n_chars == len(r.text) for r in after) and len(after) < len(before)
        if k == 2:
            classes = brute.components(texts)
            assert Counter(r.doc_id for r in after) == Counter(d for d, (_, c) in classes.items() if c == d)
        if k == 3:
            taken = {r.doc_id: r.copies for r in mixing.report(spark.createDataFrame(before, docs.schema)).collect()}
            assert Counter(r.doc_id for r in after) == Counter({d: n for d, n in taken.items() if n})
        if k == 4:
            library, text = Tokenizer.from_file(bpe.TOKENIZER), dict(texts)
            assert len(after) == len(before)
            for r in after:
                ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
                assert np.frombuffer(r.ids, "<u4").tolist() == ids
                assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, "")
        assert none.count() == 0
