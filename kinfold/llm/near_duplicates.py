"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set holds its distinct 5-word shingles.  Equal sets form a class;
only classes are compared.  A class has one MinHash value per coordinate and is
posted under each (coordinate, value).  Two classes are candidates when at
least `MATCHES` of their `COORDINATES` postings collide:

* prefix merging: postings are ordered from rare to frequent over the corpus.
  Two signatures with `MATCHES` common postings must meet within the first
  `COORDINATES - MATCHES + 1` of both, so only these are joined, and classes
  with fewer than `MATCHES` postings that anybody shares leave at once;
* skip merging: the frequent postings are never joined; the pairs found probe
  them by comparing the whole signatures, and pairs below the threshold go;
* what passes is confirmed on the full sets: 100 * common >= 75 * united.

A posting list is never expanded into all its pairs.  Its members first meet
its centre, the member of largest weight (the sum of its postings' list lengths:
among near copies, their origin).  Lists that one component covers then need
nothing more, so a group of n near copies costs about n pairs.  In the others, a
pair of different components can only link if what both share with the centre,
plus what both have outside of it and in common with anybody, is enough; those
pairs meet and are confirmed like all others.  The bound is exact, so no link
between components is lost.

The only chance involved: a pair of similarity 0.75 reaches 32 of 64 collisions
with probability 1 - 3e-6 (binomial), more above it.

Defined results: a text without words, or null, has an empty set, is linked
with nothing and is kept; equal sets are one class (128-bit fingerprints; graph
nodes are 64 bits of them); repeated rows get equal answers; a null doc_id is
never the smallest; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm import arrow_text
from kinfold.operators.components import connected_components
from kinfold.session import materialize

WORDS = 5
PERCENT = 75
COORDINATES = 64
MATCHES = 32
PARTS = 32  # a power of two
_BLOCK = 4096

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(20240229).integers(1, 2**63, (3, COORDINATES), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = arrow_text.words(pc.ascii_lower(texts))
    if not len(words.codes):
        return [np.zeros(0, np.uint64)] * len(texts)
    named = pd.util.hash_array(words.distinct.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)
    hashes = named[words.codes]
    ends = np.cumsum(words.per_row())
    n = len(hashes) - WORDS + 1
    rolled = hashes[:max(n, 0)].copy()
    for k in range(1, WORDS):
        rolled = _mixed(rolled) + hashes[k:k + max(n, 0)]
    rolled = _mixed(rolled)
    sets, start = [], 0
    for end in ends:
        if end - start >= WORDS:
            sets.append(np.unique(rolled[start:end - WORDS + 1]))
        elif end > start:  # the whole short sequence; its length keeps it apart from 5-word shingles
            one = np.uint64(end - start) * hashes[start:start + 1]
            for h in hashes[start + 1:end]:
                one = _mixed(one) + h
            sets.append(_mixed(one ^ _MIX))
        else:
            sets.append(np.zeros(0, np.uint64))
        start = end
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """One posting key per coordinate: the smallest of an affine hash, salted by the coordinate."""
    factor, offset, salt = _FACTORS
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        block = shingles[at:at + _BLOCK, None] * factor + offset
        np.minimum(least, block.min(axis=0), out=least)
    return _mixed(least ^ salt).view(np.int64)


def _sketch(texts: pa.Array) -> pa.Array:
    sizes, high, low, tokens = [], [], [], []
    for _, some in arrow_text.slices(texts):
        for shingles in shingle_sets(some):
            sizes.append(len(shingles))
            if len(shingles):
                name = _fingerprint(shingles)
                high.append(name[0])
                low.append(name[1])
                tokens.append(signature(shingles))
            else:
                high.append(None)
                low.append(None)
                tokens.append(None)
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
         pa.array(tokens, pa.list_(pa.int64()))], ["n_shingles", "high", "low", "tokens"])


def _fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(high), int(low)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list array over one buffer, without a copy per row."""
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(kind.to_pandas_dtype())))


def _sets(texts: pa.Array) -> pa.Array:
    """Fingerprint, shingles and their number per part of the hash range.

    The sets of a batch weigh more than its texts, so each slice leaves as Arrow
    columns and what it needed is given back before the next.
    """
    names, shingles, parts = ([pa.array([], kind)] for kind in (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())))
    for _, some in arrow_text.slices(texts):
        found = shingle_sets(some)
        names.append(pa.array([_fingerprint(s)[0] for s in found], pa.int64()))
        shingles.append(_lists(found, pa.int64()))
        parts.append(_lists([np.bincount((s & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS).astype(np.int32) for s in found], pa.int32()))
        del found
        pa.default_memory_pool().release_unused()
    columns = []
    for chunks in (names, shingles, parts):
        columns.append(pa.concat_arrays(chunks))
        chunks.clear()
    return pa.StructArray.from_arrays(columns, ["high", "shingles", "parts"])


def sketch_of(text: Column) -> Column:
    return F.arrow_udf(_sketch, "struct<n_shingles: long, high: long, low: long, tokens: array<long>>")(text)


def set_of(text: Column) -> Column:
    return F.arrow_udf(_sets, "struct<high: long, shingles: array<long>, parts: array<int>>")(text)


def _surviving(classes: DataFrame) -> DataFrame:
    """(node, weight, prefix) of classes that share enough postings to have a partner at all."""
    posted = classes.select("node", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    return (posted.join(shared, "token").groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared"), F.sum("n").alias("weight"))
            .filter(F.size("shared") >= MATCHES)
            .select("node", "weight", F.slice("shared.token", F.lit(1), F.size("shared") - MATCHES + 1).alias("prefix")))


def _with_member(pairs: DataFrame, members: DataFrame, side: str, *columns: str) -> DataFrame:
    return pairs.join(members.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)


def _verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) with enough collisions and enough of their sets in common."""
    for side in ("a", "b"):
        pairs = _with_member(pairs, members, side, "tokens", "n_shingles")
    n_a, n_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    collisions = F.aggregate(F.zip_with("tokens_a", "tokens_b", lambda x, y: F.when(x == y, 1).otherwise(0)),
                             F.lit(0), lambda n, x: n + x)
    near = pairs.filter((100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)) & (collisions >= MATCHES)).select("a", "b")
    for side in ("a", "b"):
        near = _with_member(near, members, side, "shingles")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    united = F.size("shingles_a") + F.size("shingles_b") - common
    return near.filter(100 * common >= PERCENT * united).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _centred(lists: DataFrame) -> DataFrame:
    """Posting lists of two members or more, each member with its list's heaviest."""
    top = lists.groupBy("token").agg(F.max(F.struct("weight", "node")).alias("top"), F.count("*").alias("n")).filter("n > 1")
    return lists.join(top, "token").select("token", "node", F.col("top.node").alias("centre"))


def _pairs(one: str, other: str) -> tuple[Column, Column]:
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def _still_open(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Lists whose members are not all of one component; `label` is a member's component, `home` the centre's."""
    label = found.select(F.col("vertex").alias("node"), F.col("component"))
    named = (lists.join(label, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))
    open_ = (named.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                        F.max(F.when(F.col("node") == F.col("centre"), F.col("label"))).alias("home"))
             .filter("least != most").select("token", "home"))
    return named.join(open_, "token")


def _by_part(shingle: str) -> Column:
    part = F.col(shingle).bitwiseAND(PARTS - 1)
    return F.array(*[F.count_if(part == p).cast("int") for p in range(PARTS)])


def _against_centre(lists: DataFrame, members: DataFrame) -> DataFrame:
    """(centre, node, n, shared, extra): set size, shingles in common with the centre, and those of the others that
    occur outside the centre in any other member of its lists; both counted by part of the hash range.
    """
    met = lists.filter("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    both = _with_member(_with_member(met, members, "a", "shingles"), members, "b", "shingles", "parts")
    sizes = materialize(both.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.size("shingles_b").alias("n"),
                                    F.col("parts_b").alias("parts"), F.array_except("shingles_b", "shingles_a").alias("added")), "near-centres")
    added = sizes.select("centre", "node", F.explode("added").alias("shingle"))
    counted = added.groupBy("centre", "node").agg(_by_part("shingle").alias("lacking"))
    seen = added.groupBy("centre", "shingle").agg(F.count("*").alias("times")).filter("times > 1").select("centre", "shingle")
    extra = added.join(seen, ["centre", "shingle"]).groupBy("centre", "node").agg(_by_part("shingle").alias("extra"))
    nothing = F.array_repeat(F.lit(0), PARTS)
    return (sizes.drop("added").join(counted, ["centre", "node"], "left").join(extra, ["centre", "node"], "left")
            .select("centre", "node", "n", F.zip_with("parts", F.coalesce("lacking", nothing), lambda x, y: x - y).alias("shared"),
                    F.coalesce("extra", nothing).alias("extra")))


def _enough(common: Column, n_a: Column, n_b: Column) -> Column:
    return 100 * common >= PERCENT * (n_a + n_b - common)


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def _remaining_pairs(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of one centre's lists but different components that may link, by what each shares with the centre.

    What two sets have in common lies in the centre, or outside of it in both.
    One of the two is outside the centre's component.  Such a member first meets
    size classes of the centre's members, as one row each with the best values in
    it; only classes that may hold a partner are opened, and their members are
    compared by totals, then by parts.
    """
    named = lists.filter("node != centre").select("centre", "node", "label", "home").distinct()
    rest = (named.join(known, ["centre", "node"]).withColumn("size_class", _size_class(F.col("n")))
            .withColumns({f"{c}_all": _total(F.col(c)) for c in ("shared", "extra")}))
    classes = rest.groupBy("centre", "size_class").agg(
        F.min("n").alias("n_c"), F.max("shared_all").alias("shared_c"), F.max("extra_all").alias("extra_c"))
    spans = F.sequence(_size_class(F.col("n") * PERCENT / 100), _size_class(F.col("n") * 100 / PERCENT))

    def may(n, shared, extra):
        common = F.least("shared_all", shared) + F.least("extra_all", extra)
        return _enough(common, F.col("n"), F.col(n))
    asked = (rest.filter("label != home").withColumn("size_class", F.explode(spans)).join(classes, ["centre", "size_class"])
             .filter(may("n_c", "shared_c", "extra_c"))
             .select("centre", "size_class", *[F.col(c).alias(f"o_{c}") for c in (
                 "node", "label", "n", "shared", "extra", "shared_all", "extra_all")]))
    parts = reduce(lambda x, y: x + y, [_total(F.zip_with(c, f"o_{c}", lambda x, y: F.least(x, y))) for c in ("shared", "extra")])
    same = (F.col("a.centre") == F.col("r.centre")) & (F.col("a.size_class") == F.col("r.size_class"))
    met = asked.alias("a").join(rest.alias("r"), same & (F.col("label") != F.col("o_label")) & may("o_n", "o_shared_all", "o_extra_all")
                                & _enough(parts, F.col("n"), F.col("o_n")))
    return met.select(*_pairs("o_node", "node")).distinct()


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(0.05)).cast("int")


def links(members: DataFrame, postings: DataFrame) -> DataFrame:
    """Links that connect whatever the full set of links connects; see the module text."""
    lists = materialize(_centred(postings), "near-lists")
    first = materialize(_verified(lists.filter("node != centre").select(*_pairs("node", "centre")).distinct(), members), "near-links")
    open_ = materialize(_still_open(lists, connected_components(first)), "near-open")
    pairs = _remaining_pairs(open_, materialize(_against_centre(open_, members), "near-known"))
    return first.unionByName(materialize(_verified(pairs, members), "near-links"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    answered = _answered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return answered.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"))


def _answered(named: DataFrame, *more: Column) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, high, low, `more`, its component's node and its smallest doc_id."""
    extra = [f"more_{i}" for i in range(len(more))]
    sketches = materialize(named.select("doc_id", sketch_of(F.col("text")).alias("s"), *[c.alias(n) for c, n in zip(more, extra)])
                           .select("doc_id", "s.n_shingles", "s.high", "s.low", "s.tokens", *extra), "near-sketches")
    classes = (sketches.filter("high IS NOT NULL").groupBy("high", "low", "n_shingles")
               .agg(F.min("doc_id").alias("first_id"), F.first("tokens").alias("tokens")))
    classes = materialize(classes.withColumn("node", F.col("high")), "near-classes")
    surviving = materialize(_surviving(classes.select("node", "tokens")), "near-surviving")
    wanted = classes.join(surviving.select("node"), "node", "left_semi")
    # One text per surviving class gives its full set; other rows of an equal doc_id have another fingerprint.
    texts = named.join(wanted.select("first_id").distinct().hint("shuffle_hash"),
                       F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    sets = (texts.select(set_of(F.col("text")).alias("s")).groupBy(F.col("s.high").alias("node"))
            .agg(F.first("s.shingles").alias("shingles"), F.first("s.parts").alias("parts")))
    members = materialize(wanted.select("node", "n_shingles", "tokens").join(sets, "node"), "near-members")
    lists = surviving.select("node", "weight", F.explode("prefix").alias("token"))
    found = connected_components(links(members, lists)).withColumnRenamed("vertex", "node")
    labelled = (classes.select("high", "low", "first_id", "node").join(found, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named_classes = labelled.join(smallest, "component").select("high", "low", "component", "component_id")
    rows = sketches.select("doc_id", "n_shingles", "high", "low", *extra)
    return rows.join(named_classes, ["high", "low"], "left")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each group kept, with all its columns: the smallest doc_id, then the smallest MD5 of the text.

    Decided per row, not per doc_id, so another text under the id of a copy stays.
    Rows equal in id and text are one document, and any one of them stays; texts
    without words are in no group.
    """
    columns = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    doc_id, text = (f"c{columns.index(c)}" for c in (doc_id, text))
    answered = materialize(_answered(inner.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), F.md5(F.col("text")))
                           .filter("component IS NOT NULL").select("component", "doc_id", F.col("more_0").alias("md5")), "near-answers")
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "md5")
    rows = answered.groupBy("component", "doc_id", "md5").agg(F.count("*").alias("n"))
    first = rows.groupBy("component").agg(F.min(least).alias("first"))
    judged = rows.join(first, "component").withColumn("stays", least == F.col("first"))
    marked = materialize(judged.filter("NOT stays OR n > 1").select(
        F.col("doc_id").alias("of_id"), F.col("md5").alias("of_md5"), "stays"), "near-marked")
    same = F.col(doc_id).eqNullSafe(F.col("of_id")) & (F.md5(F.col(text)) == F.col("of_md5"))
    single = inner.join(marked, same, "left_anti")
    if marked.filter("stays").isEmpty():
        return single.toDF(*columns)
    repeated = (inner.join(marked.filter("stays"), same, "left_semi").withColumn("md5", F.md5(F.col(text)))
                .dropDuplicates([doc_id, "md5"]).drop("md5"))
    return single.unionByName(repeated).toDF(*columns)
