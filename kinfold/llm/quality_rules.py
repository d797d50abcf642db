"""Quality rules: divergence of a document's histograms from its language's.

One pass over the texts gives counts, a histogram of character classes and a
histogram of common words (plus words of marks alone, and all others).  A
document is rejected when the Jensen-Shannon distance (base 2, 0..1) of either
histogram to its language's clean reference exceeds the threshold.

The clean reference is taken over the whole corpus from documents that pass the
base rules and the length guard, and neither length nor copies give weight:
documents of one language whose shares agree after rounding to `CELL_STEP` (so
all copies, and most near copies) are one cell; the medians of the cells' shares
are a first reference, and the sum of the shares of the cells near it is the
clean one.  So junk moves it only if it fills half of a language's cells.  If no cell is near, all
cells are summed.  `report` also gives the distances to the plain sum of counts.

Defined results: a null or empty text has no words and fails the base rules; a
null language is a language of its own; without a reference nothing diverges;
repeated rows are judged alike, each returned; an empty table gives no rows.
Other columns are passed through by `judge`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm import arrow_text
from kinfold.llm.arrow_text import pair_codes
from kinfold.session import materialize

# Frequent function words of four languages, the common-word bins.
COMMON_WORDS = (
    "the of and to in a is that for was with be "
    "le la les de des et un une du que est pas "
    "der die und das den von ist mit ein nicht zu auf "
    "el los las que y en por un una con se no"
)
WORD_BINS = (*dict.fromkeys(COMMON_WORDS.split()), "")  # the last bin: words of marks and symbols alone
CHAR_CLASSES = ("lower", "upper", "digit", "space", "line_end", "stop", "mark", "symbol", "latin_extra", "other")
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?\"'()[]{}-_=+~/\\^@`" + SYMBOLS

MIN_WORDS = 50        # fewer fail the base rules
REPEAT_PERCENT = 50   # more repeated words fail the base rules
GUARD_WORDS = 50      # fewer are not judged by divergence; no more than the base rules ask for
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
CELL_STEP = 0.02      # shares that agree after rounding to it are one cell of the reference
MEDIAN_PARTS = 2000   # medians are exact on shares in such parts, so their buffers are bounded

FEATURES = ("n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
            "chars: array<long>, common: array<long>")


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte; continuation bytes have none, so a character counts once."""
    at = CHAR_CLASSES.index
    table = np.full(256, at("mark"), np.int32)
    for first, last, name in (("a", "z", "lower"), ("A", "Z", "upper"), ("0", "9", "digit")):
        table[ord(first):ord(last) + 1] = at(name)
    table[[0x09, 0x0B, 0x0C, 0x0D, 0x20]] = at("space")
    table[0x0A] = at("line_end")
    table[[ord(c) for c in ".,;:"]] = at("stop")
    table[[ord(c) for c in SYMBOLS]] = at("symbol")
    table[0x80:0xC0] = -1
    table[0xC0:0xC6] = at("latin_extra")
    table[0xC6:] = at("other")
    return table


_CLASS = _class_table()


def _char_histogram(texts: pa.Array) -> np.ndarray:
    raw, rows = arrow_text.string_bytes(texts)
    kinds = _CLASS[raw]
    there = kinds >= 0
    size = len(CHAR_CLASSES)
    return np.bincount(rows[there] * np.int32(size) + kinds[there], minlength=len(texts) * size).reshape(-1, size)


def _common_histogram(words: arrow_text.Pieces) -> np.ndarray:
    plain = pc.utf8_trim(pc.ascii_lower(words.distinct), characters=MARKS)
    bins = pc.fill_null(pc.index_in(plain, value_set=pa.array(WORD_BINS, plain.type)), len(WORD_BINS))
    of_word = bins.to_numpy(zero_copy_only=False).astype(np.int64)[words.codes] if len(words.codes) else words.codes
    size = len(WORD_BINS) + 1
    return np.bincount(words.rows * size + of_word, minlength=words.n_rows * size).reshape(-1, size)


def _repeat_words(words: arrow_text.Pieces) -> np.ndarray:
    """Words inside 3-word windows that the same text holds twice or more."""
    codes, rows = words.codes, words.rows
    if len(codes) < 3:
        return np.zeros(words.n_rows, np.int64)
    inside = rows[:-2] == rows[2:]
    size = len(words.distinct)
    two, n_two = pair_codes(codes[:-2], codes[1:-1], size)
    three, n_three = pair_codes(two, codes[2:], size)
    in_row, _ = pair_codes(three, rows[:-2], words.n_rows)
    in_row = np.where(inside, in_row, -1)
    twice = np.bincount(in_row[inside], minlength=1) > 1 if inside.any() else np.zeros(1, bool)
    hit = inside & twice[np.maximum(in_row, 0)] if inside.any() else inside
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift:len(codes) - 2 + shift] |= hit
    return np.bincount(rows[covered], minlength=words.n_rows)


def _dup_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    lines = arrow_text.split_on(texts, "\n")
    if not len(lines.codes):
        return np.zeros(len(texts), np.int64)
    bare = pc.utf8_trim(lines.distinct, characters="\t\n\x0b\x0c\r ")
    worded = pc.greater(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)[lines.codes]
    rows, codes = lines.rows[worded], lines.codes[worded]
    seen, n_seen = pair_codes(rows, codes, len(lines.distinct))
    first = np.zeros(n_seen, np.int64)
    first[seen] = rows
    return np.bincount(rows, minlength=len(texts)) - np.bincount(first, minlength=len(texts))


def measure(texts: pa.Array) -> pa.Array:
    """The features of each text, in slices of bounded bytes."""
    parts = []
    for _, some in arrow_text.slices(texts):
        words = arrow_text.words(some)
        lengths = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False)
        chars, common = _char_histogram(some), _common_histogram(words)
        long_ = lambda x: pa.array(np.asarray(x, np.int64))
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, h.size + 1, h.shape[1], dtype=np.int32)), long_(h.ravel()))
                 for h in (chars, common)]
        parts.append(pa.StructArray.from_arrays(
            [long_(words.per_row()), long_(words.per_row(lengths[words.codes] if len(words.codes) else None)),
             long_(chars[:, CHAR_CLASSES.index("symbol")]), long_(_dup_lines(some)), long_(_repeat_words(words)), *lists],
            ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common"]))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
        [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [(n, pa.list_(pa.int64())) for n in ("chars", "common")]))


def features_of(text: Column) -> Column:
    return F.arrow_udf(measure, f"struct<{FEATURES}>")(text)


def base_failed(f: str) -> Column:
    n = F.col(f"{f}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{f}.n_repeat_words") > REPEAT_PERCENT * n)


def references(measured: DataFrame, lang: str, f: str) -> DataFrame:
    """Per language the plain sums of counts of all documents that pass the base rules and the guard.

    One combinable sum per bin: a language with most of the rows sends one row per task.
    """
    def summed(name, size):
        return F.array(*[F.sum(F.col(f"{f}.{name}")[i]) for i in range(size)]).alias(f"ref_{name}")
    return (measured.filter(~base_failed(f) & (F.col(f"{f}.n_words") >= GUARD_WORDS)).groupBy(F.col(lang).alias("ref_lang"))
            .agg(summed("chars", len(CHAR_CLASSES)), summed("common", len(WORD_BINS) + 1)))


def share(h: Column) -> Column:
    total = F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    return F.transform(h, lambda x: x / F.nullif(total, F.lit(0.0)))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms in base 2; null if either is empty."""
    def term(p, m):
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    halves = F.zip_with(share(counts), share(reference), lambda p, q: term(p, (p + q) / 2) + term(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(halves, F.lit(0.0), lambda a, x: a + x) / 2))


def is_far(chars: Column, common: Column) -> Column:
    return F.coalesce(chars > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(common > MAX_WORD_DISTANCE, F.lit(False))


def clean_references(measured: DataFrame, lang: str, f: str) -> DataFrame:
    """Per language the summed shares of the cells near the median cell (see above).

    Cells, medians and sums are combinable aggregates; a group of copies is one row per task.
    """
    sizes = {"chars": len(CHAR_CLASSES), "common": len(WORD_BINS) + 1}
    shares = measured.filter(~base_failed(f) & (F.col(f"{f}.n_words") >= GUARD_WORDS)).select(
        F.col(lang).alias("ref_lang"), *[share(F.col(f"{f}.{name}")).alias(name) for name in sizes])
    cell = F.md5(F.to_json(F.struct(*[F.transform(name, lambda x: F.round(x / CELL_STEP).cast("int")).alias(name) for name in sizes])))
    cells = materialize(shares.groupBy("ref_lang", cell.alias("cell")).agg(F.min(F.struct(*sizes)).alias("s"))
                        .select("ref_lang", "s.*"), "quality-cells")

    def median(name, size):
        return F.array(*[F.percentile(F.round(F.col(name)[i] * MEDIAN_PARTS).cast("int"), 0.5) for i in range(size)]).alias(f"mid_{name}")
    mids = materialize(cells.groupBy(F.col("ref_lang").alias("mid_lang")).agg(*[median(*x) for x in sizes.items()]), "quality-medians")
    near = ~is_far(*[distance(F.col(name), F.col(f"mid_{name}")) for name in sizes])
    met = cells.join(mids, F.col("ref_lang").eqNullSafe(F.col("mid_lang"))).withColumn("near", near)

    def summed(name, size):
        part = [F.round(F.col(name)[i] * 1_000_000).cast("long") for i in range(size)]
        return F.coalesce(F.when(F.count_if("near") > 0, F.array(*[F.sum(F.when(F.col("near"), x)) for x in part])),
                          F.array(*[F.sum(x) for x in part])).alias(f"ref_{name}")
    return met.groupBy("ref_lang").agg(*[summed(*x) for x in sizes.items()])


def verdicts(measured: DataFrame, refs: DataFrame, lang: str, f: str, out: str) -> DataFrame:
    """`measured` with a struct `out`: base_failed, both distances, kept."""
    joined = measured.join(refs, F.col(lang).eqNullSafe(F.col("ref_lang")), "left")
    chars, common = distance(F.col(f"{f}.chars"), F.col("ref_chars")), distance(F.col(f"{f}.common"), F.col("ref_common"))
    far = is_far(chars, common)
    judged = F.col(f"{f}.n_words") >= GUARD_WORDS
    return joined.withColumn(out, F.struct(
        base_failed(f).alias("base_failed"), chars.alias("char_distance"), common.alias("word_distance"),
        (~base_failed(f) & ~(judged & far)).alias("kept")))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every document; the texts are read once."""
    measured = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"),
                                       features_of(F.col(text)).alias("f")), "quality-features")
    clean = materialize(clean_references(measured, "lang", "f"), "quality-references")
    judged = verdicts(measured, clean, "lang", "f", "v").drop("ref_lang", "ref_chars", "ref_common")
    plain = verdicts(judged, references(measured, "lang", "f"), "lang", "f", "p")
    return plain.select("doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
                        "v.base_failed", "v.kept", "p.char_distance", "p.word_distance",
                        F.col("v.char_distance").alias("clean_char_distance"), F.col("v.word_distance").alias("clean_word_distance"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are kept, with all their columns and nothing else.

    Texts are measured once: the rows are written with their features, then judged.
    """
    columns = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text, lang = (f"c{columns.index(c)}" for c in (text, lang))
    measured = materialize(inner.withColumn("f", features_of(F.col(text))), "quality-measured")
    refs = materialize(clean_references(measured.select(lang, "f"), lang, "f"), "quality-references")
    judged = verdicts(measured, refs, lang, "f", "v").filter("v.kept")
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
