"""Spelling variants by pivotal grams: near words, the form of each, and the root of its chain.

Words come from the maximal runs of letters of whole texts (`RUN`), A-Z lowered;
a run whose crc32 with its doc_id is divisible by `SLIP` loses one code point
(the planted slips of the contract).  Counts are combined per task, then summed.

Near words (one inserted, deleted or replaced code point) are found by pivotal
grams.  Bigrams are ordered by their number in the vocabulary.  A word's prefix
holds its three rarest bigram positions, and every further position of the same
bigrams as the last; its pivots are two disjoint positions of the prefix, chosen
by dynamic programming for the smallest total count.  One edit spoils at most one
of two disjoint grams.  Of two near words take the one whose prefix ends at the
rarer bigram: its unspoilt pivot is no more frequent than the end of the other's
prefix, so the other has it there.  So pivots joined with prefixes lose no pair.

Position limits: the edit's place relative to the two pivots says which parts of
the word are untouched, and the join is on these parts, with the length (off by
one at most), instead of on the bigram alone:

* behind both pivots: the head through the second; before both: the tail from the
  first; between them: the head through the first and the tail from the second.  Both
  pivots are then in the other's prefix;
* in a pivot: the parts before and behind it; the other pivot lies in one of them.

A word answers under every such part of its own that holds a prefix bigram (both,
where both pivots are untouched).  What meets is verified exactly.

The form of a word is its near word with the largest count (ties: the smallest
in code-point order), if at least `RATIO` times its own.  Counts grow at every
step, so chains end; roots follow by pointer doubling.

Defined results: null and empty texts have no words; very long texts are cut
between runs only; a null doc_id counts as an empty one in the crc32; repeated
rows count again; an empty table gives no rows; other columns are not read.
The bigram counts are the only thing broadcast: at most 90 * 90 of them, as runs
have 90 different code points.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinfold.session import materialize

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
SLIP = 97
PREFIX = 3
RUN = re.compile("[a-z\u00c0-\u00ff]{%d,}" % LEAST_LENGTH)  # in lowered text; shorter runs give no word
_CUT = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
_PIECE = 1 << 20
_HELD = 200_000  # distinct words a task holds before it hands their counts on


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in parts of about a MB, cut at ASCII characters that no run holds."""
    start = 0
    while len(text) - start > _PIECE:
        cut = _CUT.search(text, start + _PIECE)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def _without(run: str, h: int) -> str:
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush():
        words, counts = list(held), list(held.values())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not text.is_valid:
                continue
            start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            for piece in _pieces(text.as_buffer().to_pybytes().lower()):
                for run, n in Counter(RUN.findall(piece.decode())).items():
                    h = zlib.crc32(run.encode(), start)
                    held[run if h % SLIP else _without(run, h)] += n
                if len(held) > _HELD:
                    yield flush()
    yield flush()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least `LEAST_LENGTH` code points that occur `LEAST_COUNT` times or more."""
    named = docs.select(F.col(doc_id).cast("long"), F.col(text))
    counted = named.mapInArrow(_count, "word string, n long")
    return (counted.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


def pivots(prefix: list[tuple[int, int]]) -> tuple[int, int]:
    """Two disjoint bigram positions of the smallest total count, out of (position, count)."""
    best, single = None, None  # the cheapest pair so far; the cheapest gram that ends before the present one
    waiting = []
    for at, count in sorted(prefix):
        while waiting and waiting[0][0] + 2 <= at:
            one = waiting.pop(0)
            if single is None or one[1] < single[1]:
                single = one
        if single is not None and (best is None or single[1] + count < best[0]):
            best = (single[1] + count, single[0], at)
        waiting.append((at, count))
    return best[1], best[2]


#: An untouched part is a head of so many letters and the tail from a position; kinds keep parts of other origin apart.
THROUGH, FROM, AROUND, BESIDE = range(4)
_BITS = 28


def _part(kind: int, head: int, tail: int) -> int:
    return (kind << 2 * _BITS) + (head << _BITS) + tail


def asked_parts(n: int, first: int, second: int) -> list[int]:
    """What stays untouched of a word of n letters with two pivots, one per place of the edit."""
    return [_part(THROUGH, second + 2, n), _part(FROM, 0, first), _part(AROUND, first + 2, second),
            _part(BESIDE, first, first + 2), _part(BESIDE, second, second + 2)]


def answered_parts(n: int, prefix: list[int]) -> list[int]:
    """The parts by which a word is met by one that has its untouched pivots among the word's prefix positions."""
    prefix = sorted(prefix)
    first, last = prefix[0], prefix[-1]
    parts = {_part(THROUGH, b + 2, n) for b in prefix if first + 2 <= b}
    parts |= {_part(FROM, 0, a) for a in prefix if a + 2 <= last}
    parts |= {_part(AROUND, a + 2, b) for a in prefix for b in prefix if a + 2 <= b}
    # Where the other word has its spoilt pivot, this one has one to three letters.
    return [*parts, *[_part(BESIDE, a, a + gap) for gap in (1, 2, 3) for a in range(n - gap + 1) if first + 2 <= a or a + gap <= last]]


def _selector(counts: dict[str, int]):
    # One number per bigram, in the order of (count, bigram).
    rank = {gram: i for i, gram in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def select(batches):
        for batch in batches:
            asked, answered = [], []
            for word in batch.column(0).to_pylist():
                ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
                end = sorted(ranks)[PREFIX - 1]
                prefix = [i for i, r in enumerate(ranks) if r <= end]
                asked.append(asked_parts(len(word), *pivots([(i, counts[word[i:i + 2]]) for i in prefix])))
                answered.append(answered_parts(len(word), prefix))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(asked, longs), pa.array(answered, longs)],
                                             ["word", "asked", "answered"])
    return select


def grams(words: DataFrame) -> DataFrame:
    """(word, asked, answered): the parts of distinct words of five code points or more."""
    bigrams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1),
                                                 lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    counts = {r.gram: r.n for r in bigrams.groupBy("gram").agg(F.count("*").alias("n")).collect()}  # 90 * 90 at most
    return words.select("word").mapInArrow(_selector(counts), "word string, asked array<bigint>, answered array<bigint>")


def _keyed(parts: DataFrame, word: str) -> DataFrame:
    """(key, word) of (word, part, length of the word that answers)."""
    head, tail = (F.shiftright("part", _BITS).bitwiseAND((1 << _BITS) - 1), F.col("part").bitwiseAND((1 << _BITS) - 1))
    key = F.xxhash64(F.shiftright("part", 2 * _BITS), "length", F.substring(F.col("word"), F.lit(1), head.cast("int")),
                     F.substring(F.col("word"), (tail + 1).cast("int"), F.length("word")))
    return parts.select(key.alias("key"), F.col("word").alias(word))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct `word`s that are one edit apart."""
    selected = materialize(grams(words), "spelling-grams")
    size = F.length("word")
    asks = selected.select("word", F.explode("asked").alias("part")).select("word", "part", F.explode(F.array(size - 1, size, size + 1)).alias("length"))
    answers = selected.select("word", F.explode("answered").alias("part")).withColumn("length", size)
    met = _keyed(asks, "one").join(_keyed(answers, "other"), "key").filter(F.levenshtein("one", "other", 1) == 1)
    return met.select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): the last of its chain, by pointer doubling.

    Counts at least double at each step and fit a long, so six rounds reach every end.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(6):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on"))
        moved = materialize(moved, "spelling-roots")
        at = moved.select("word", "root")
        if moved.filter("on").isEmpty():
            break
    return at


def variants(words: DataFrame) -> DataFrame:
    """Per (word, n): form, root, n, n_near, form_n."""
    pairs = materialize(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    named = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = named.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    more = -F.col("best.less") >= RATIO * F.col("n")
    formed = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(more, F.col("best.form")).alias("form"),
        F.when(more, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return variants(materialize(word_counts(docs, doc_id, text), "spelling-words"))
