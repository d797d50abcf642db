"""N-gram Jaccard join by a token-group matrix; documents are joined into components.

A document's set holds its distinct 3-word shingles (tokens).  Equal sets are one
class, and only classes are compared.

Tokens have one order over the corpus: first those in a quarter of the hash range,
by their number of classes (counted over the whole corpus), then the others by
hash.  Sets of similarity 0.9 share a token among the first tenth of both (their
prefixes), whatever the order; classes whose prefix holds no token of anybody
else's prefix are done.

1. Linear merging: similar documents are brought together by sorting on size class
   and MinHash and cut into groups of a bounded number of tokens; inside a group
   all pairs are counted at once.  Each component then sends one member, the one
   with the least of its own, into a second round sorted by another MinHash.  A
   group of near copies is mostly one component after that.
2. Token-group matrix: documents that share prefix tokens with another component
   get new prefixes, with all their tokens in order of the number of these documents
   that hold them, and those that still share one are dealt into groups anew, by
   component, then MinHash; only the last group of a size class is not full.  The matrix holds each group's token union, its sizes and, for
   probing, its members' prefix tokens.  A document probes with its own prefix in
   the size classes that it can link with.  (token, size class) entries on which
   all documents are of one component are closed, and groups that are wholly of the
   document's component are passed by.
3. The bound: what a document shares with any member is at most what it shares with
   the group's union.  Only groups where that is enough are opened, and their
   members' exact overlaps decide: 100 * common >= 90 * united.

Documents already connected need no further link, all others are searched without
caps, so components are exact.  Only one link per other component leaves a group.

Defined results: null texts and texts without words have no tokens and are linked
with nothing; equal sets are one class (128-bit fingerprints; tokens and graph nodes
are of 64 bits);
a very long text is a group of its own with its neighbour in the order; repeated
rows get equal answers; a null doc_id is never the smallest; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.llm import arrow_text
from kinfold.operators.components import connected_components
from kinfold.session import materialize

WORDS = 3
PERCENT = 90
LEAST = -(-PERCENT // (100 - PERCENT))  # smaller sets link with equal ones only
COUNTED = 1 << 62  # tokens below it, a quarter, are ordered by frequency
GROUP = 64                # documents of a group at most
GROUP_TOKENS = 2_000_000  # and tokens, but two documents at least
BLOCK_TOKENS = 2_000_000  # tokens of the queries that meet one group in a task, on average
KEYS = 3                  # MinHash keys for the order

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.random.default_rng(20251).integers(1, 2**63, KEYS, np.uint64)
_COLUMNS = 1 << 16


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = (h ^ (h >> np.uint64(28))) * _MIX
    return h ^ (h >> np.uint64(32))


def token_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct tokens of each text; a text of fewer words is one token."""
    words = arrow_text.words(pc.ascii_lower(texts))
    if not len(words.codes):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes = pd.util.hash_array(words.distinct.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)[words.codes]
    rolled = hashes.copy()
    for k in range(1, WORDS):  # row i ends up with words i to i + WORDS - 1
        rolled[:len(hashes) - k] = _mixed(rolled[:len(hashes) - k]) + hashes[k:]
    rolled = _mixed(rolled)
    ends = np.cumsum(words.per_row())
    sets = []
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        if end - start >= WORDS:
            sets.append(np.unique(rolled[start:end - WORDS + 1]))
        elif end > start:
            short = np.full(1, end - start, np.uint64)  # the length keeps it apart from the tokens of longer texts
            for at in range(start, end):
                short = _mixed(short ^ _MIX) + hashes[at:at + 1]
            sets.append(_mixed(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _name(tokens: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64)
    return int(high), int(low)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))).cast(pa.list_(pa.int64()))


def _needed(n: int) -> int:
    """What a set of n tokens has in common at least with any set it links with."""
    return -(-PERCENT * n // 100)


def _sketch(texts: pa.Array) -> pa.Array:
    """Size, fingerprint, and the tokens from which prefixes are made: the counted ones, and as many more as a prefix may need."""
    sizes, names, tokens = [], [], []
    for _, some in arrow_text.slices(texts):
        for t in token_sets(some):
            sizes.append(len(t))
            names.append(_name(t) if len(t) else (None, None))
            prefix = len(t) - _needed(len(t)) + 1
            tokens.append(t[:max(int(np.searchsorted(t, np.uint64(COUNTED))), prefix)] if len(t) >= LEAST else t[:0])
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array([h for h, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int64()), _lists(tokens)],
        ["n", "high", "low", "tokens"])


def _whole(texts: pa.Array) -> pa.Array:
    """Fingerprint, all tokens, and MinHash keys."""
    found = [t for _, some in arrow_text.slices(texts) for t in token_sets(some)]
    keys = [np.array([_mixed(t ^ s).min() for s in _SALTS], np.uint64) if len(t) else np.zeros(KEYS, np.uint64) for t in found]
    names = [_name(t) for t in found]
    return pa.StructArray.from_arrays(
        [pa.array([h for h, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int64()), _lists(found), _lists(keys)],
        ["high", "low", "tokens", "keys"])


def _is_counted(token: Column) -> Column:
    return (token >= 0) & (token < COUNTED)


def prefixes(sketches: DataFrame, is_counted: Callable[[Column], Column] = _is_counted) -> DataFrame:
    """(node, token, probes, single) of every prefix token that several classes have in their prefixes.

    `probes` marks the shorter prefix that a set needs among sets not smaller than itself; `single` is the number of
    counted tokens that no other class has.  Copies of a class count once.
    """
    long_ = sketches.filter(F.col("n") >= LEAST).withColumnRenamed("high", "node")
    # Dealt by token once: counting and joining the counts back need no further shuffle.
    counted = (long_.select("node", F.explode(F.filter("tokens", is_counted)).alias("token"))
               .repartition("token").dropDuplicates(["token", "node"]))
    shared = counted.groupBy("token").agg(F.count("*").alias("f")).filter("f > 1")
    known = counted.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("known"))
    sized = long_.groupBy("node").agg(F.first("n").alias("n"), F.first(F.size(F.filter("tokens", is_counted))).alias("counted"),
                                      F.first(F.filter("tokens", lambda x: ~is_counted(x))).alias("rest"))
    n, single = F.col("n"), F.col("counted") - F.coalesce(F.size("known"), F.lit(0))
    ordered = F.concat(F.coalesce(F.col("known.token"), F.array().cast("array<bigint>")), F.col("rest"))
    as_larger = n - F.ceil(n * PERCENT / 100) + 1
    as_smaller = n - F.ceil(n * 2 * PERCENT / (100 + PERCENT)) + 1
    posted = (sized.join(known, "node", "left").withColumn("single", single)
              .withColumn("reach", as_smaller - F.col("single"))
              .withColumn("prefix", F.slice(ordered, F.lit(1), F.greatest(as_larger - F.col("single"), F.lit(0)).cast("int")))
              .select("node", "single", "reach", F.posexplode("prefix").alias("at", "token")))
    posted = materialize(posted.select("node", "token", (F.col("at") < F.col("reach")).alias("probes"), "single"), "group-posted")
    met = posted.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1").select("token")
    return posted.join(met, "token")


def size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / float(-np.log(PERCENT / 100))).cast("int")


def _group_size(klass: Column) -> Column:
    """Documents of a group, so that those of the class's largest size keep within `GROUP_TOKENS`."""
    largest = F.exp((klass + 1) * float(-np.log(PERCENT / 100)))
    return F.greatest(F.lit(2), F.least(F.lit(GROUP), F.floor(F.lit(float(GROUP_TOKENS)) / largest))).cast("bigint")


def _sorted(members: DataFrame, *order: Column) -> DataFrame:
    keys = [F.col("class"), *order, F.col("node")]
    return members.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())


def in_order(members: DataFrame, *order: Column) -> DataFrame:
    """`members` with a `group`: runs of bounded length, of one size class, in the order given; none leaves its partition."""
    return _sorted(members, *order).withColumn("group", F.floor(F.col("row") / _group_size(F.col("class"))).cast("bigint")).drop("row")


def in_full_groups(members: DataFrame, *order: Column) -> DataFrame:
    """As `in_order`, but groups run on across partitions: all of a size class are full but its last, however many partitions there are."""
    ordered = materialize(_sorted(members, *order).withColumn("part", F.spark_partition_id()), "group-ordered")
    parts = ordered.groupBy("class", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("class", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("start"))
    return (ordered.join(F.broadcast(starts), ["class", "part"])
            .withColumn("group", F.floor((F.col("row") + F.col("start")) / _group_size(F.col("class"))).cast("bigint")).drop("row", "part", "start"))


def _links(common: Column | np.ndarray, n_a, n_b):
    return 100 * common >= PERCENT * (n_a + n_b - common)


def _common_counts(tokens: list[np.ndarray]) -> np.ndarray:
    """Common tokens of every two of a few sets, by products of parts of their incidence matrix."""
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    codes, _ = pd.factorize(np.concatenate(tokens))
    several = np.bincount(codes) > 1
    column = np.cumsum(several) - 1
    keep = several[codes]
    owner, codes = owner[keep], column[codes[keep]]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    counts = np.zeros((len(tokens), len(tokens)))
    for start in range(0, int(several.sum()), _COLUMNS):
        a, b = np.searchsorted(codes, [start, start + _COLUMNS])
        part = np.zeros((len(tokens), min(_COLUMNS, int(several.sum()) - start)), np.float32)
        part[owner[a:b], codes[a:b] - start] = 1
        counts += part @ part.T
    return counts.astype(np.int64)


def _spanning(tokens: list[np.ndarray], nodes: list[int]) -> list[tuple[int, int]]:
    """Links that connect what the links among these documents connect."""
    n = np.array([len(t) for t in tokens])
    counts = _common_counts(tokens)
    a, b = np.nonzero(np.triu(_links(counts, n[:, None], n[None, :]), 1))
    parent = list(range(len(tokens)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[q] = p
            out.append((nodes[x], nodes[y]))
    return out


def _row_arrays(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _link_batch(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], ["src", "dst"])


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each group of partitions sorted by group; a group never leaves its partition."""
    group, nodes, tokens = None, [], []
    for batch in batches:
        for key, node, t in zip(zip(batch.column("class").to_pylist(), batch.column("group").to_pylist()),
                                batch.column("node").to_pylist(), _row_arrays(batch.column("tokens"))):
            if key != group:
                if len(nodes) > 1:
                    yield _link_batch(_spanning(tokens, nodes))
                group, nodes, tokens = key, [], []
            nodes.append(node)
            tokens.append(t.copy())
    if len(nodes) > 1:
        yield _link_batch(_spanning(tokens, nodes))


def merge_round(members: DataFrame, key: int) -> DataFrame:
    """Links found inside groups ordered by the `key`th MinHash."""
    ordered = in_order(members, F.col("keys")[key], F.col("keys")[(key + 1) % KEYS])
    return ordered.select("class", "group", "node", "tokens").mapInArrow(_inside, "src long, dst long")


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`rows` with the `label` of their component so far; a row without a link is its own."""
    found = connected_components(links).select(F.col("vertex").alias("node"), "component")
    return rows.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")


def _bound(unions: pa.Table, asked: pa.Table) -> pa.Table:
    """The queries that share enough with the union of the group's tokens."""
    keep = np.zeros(asked.num_rows, bool)
    if unions.num_rows:
        union = np.sort(_row_arrays(unions.column("union").combine_chunks())[0])
        least = unions.column("least")[0].as_py()
        for i, t in enumerate(_row_arrays(asked.column("tokens").combine_chunks())):
            at = np.minimum(np.searchsorted(union, t), len(union) - 1)
            keep[i] = _links(int((union[at] == t).sum()), len(t), max(len(t), least))
    return asked.select(["class", "group", "query", "query_n", "query_label"]).filter(pa.array(keep))


def _open(held: pa.Table, asked: pa.Table) -> pa.Table:
    """Exact overlaps of the queries with the members; a link to one member of each other component."""
    out = []
    if held.num_rows:
        sets = _row_arrays(held.column("tokens").combine_chunks())
        nodes, labels = held.column("node").to_pylist(), held.column("label").to_pylist()
        n = np.array([len(t) for t in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        for query, label, t in zip(asked.column("query").to_pylist(), asked.column("query_label").to_pylist(),
                                   _row_arrays(asked.column("tokens").combine_chunks())):
            first, last = np.searchsorted(flat, t, "left"), np.searchsorted(flat, t, "right")
            counts = last - first
            places = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            common = np.bincount(owner[places], minlength=len(sets))
            met = {}
            for i in np.flatnonzero(_links(common, len(t), n)).tolist():
                if labels[i] != label:
                    met.setdefault(labels[i], nodes[i])
            out += [(query, node) for node in met.values()]
    return pa.table([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["src", "dst"])


def _in_blocks(pairs: DataFrame) -> DataFrame:
    """`pairs` with a `block` per group, and the number of blocks of each group, so that no group of queries is unbounded."""
    sizes = pairs.groupBy("class", "group").agg(F.ceil(F.sum("query_n") / BLOCK_TOKENS).alias("blocks"))
    return pairs.join(sizes, ["class", "group"]).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")))


def _replicated(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    blocks = pairs.select("class", "group", "blocks").distinct()
    return groups.join(blocks, ["class", "group"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("blocks")


def matrix(grouped: DataFrame) -> DataFrame:
    """One row per group: its token union, its least size, and its component where all members are of one."""
    return grouped.groupBy("class", "group").agg(
        F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"), F.min("n").alias("least"),
        F.when(F.min("label") == F.max("label"), F.min("label")).alias("group_label"))


def candidates(grouped: DataFrame, groups: DataFrame, posted: DataFrame) -> DataFrame:
    """(class, group, query, query_n, query_label): groups that hold a query's prefix token, in open entries only."""
    named = posted.join(grouped.select("node", "n", "class", "group", "label"), "node")
    cells = materialize(named.groupBy("token", "class", "group").agg(F.min("label").alias("least"), F.max("label").alias("most")), "group-cells")
    reach = F.sequence(size_class(F.col("n")), size_class(F.floor(F.col("n") * 100 / PERCENT)))
    probes = named.filter("probes").select("token", F.col("node").alias("query"), F.col("n").alias("query_n"),
                                             F.col("label").alias("query_label"), F.explode(reach).alias("class"))
    entries = probes.select("token", "class", F.col("query_label").alias("least"), F.col("query_label").alias("most")).unionByName(
        cells.select("token", "class", "least", "most"))
    open_ = materialize(entries.groupBy("token", "class").agg(F.min("least").alias("least"), F.max("most").alias("most"))
                        .filter("least != most").select("token", "class"), "group-entries")
    # The component with the most groups of an entry: its own documents pass by groups that are wholly of it.
    open_cells = cells.join(open_, ["token", "class"]).withColumn("one", F.when(F.col("least") == F.col("most"), F.col("least")))
    home = (open_cells.filter("one IS NOT NULL").groupBy("token", "class", "one").agg(F.count("*").alias("times"))
            .groupBy("token", "class").agg(F.max(F.struct("times", "one")).alias("top")).select("token", "class", F.col("top.one").alias("home")))
    sides = groups.select("class", "group", "group_label")
    open_cells = (open_cells.join(sides, ["class", "group"]).join(home, ["token", "class"], "left")
                  .withColumn("at_home", F.coalesce(F.col("group_label") == F.col("home"), F.lit(False))))
    asked = (probes.join(open_, ["token", "class"]).join(home, ["token", "class"], "left")
             .withColumn("meets_home", F.explode(F.when(F.coalesce(F.col("query_label") == F.col("home"), F.lit(False)), F.array(F.lit(False)))
                                                .otherwise(F.array(F.lit(False), F.lit(True))))).drop("home"))
    met = asked.join(open_cells.select("token", "class", "group", "group_label", F.col("at_home").alias("meets_home")), ["token", "class", "meets_home"])
    return (met.filter(F.col("group_label").isNull() | (F.col("group_label") != F.col("query_label")))
            .select("class", "group", "query", "query_n", "query_label").distinct())


def unsettled(labelled: DataFrame, posted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents that may link with another component, and their prefixes by the frequency of all tokens among them.

    A link shares a prefix token in every order of the tokens, so it is among the documents of tokens that several
    components hold, and again among those of the new prefixes.  Near copies that do not link with each other differ in
    more tokens than a probing prefix has, and only such tokens come first when all are counted.
    """
    held = posted.select("node", "token").join(labelled.select("node", "label"), "node")
    several = held.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least != most").select("token")
    nodes = held.join(several, "token").select("node").distinct()
    left = materialize(labelled.join(nodes, "node", "left_semi"), "group-unsettled")
    again = materialize(prefixes(left.select(F.col("node").alias("high"), "n", "tokens"), lambda token: token.isNotNull()), "group-prefixes")
    return left.join(again.select("node").distinct(), "node", "left_semi"), again


def search(members: DataFrame, posted: DataFrame, links: DataFrame) -> DataFrame:
    """Links between documents that `links` does not connect; see the module text."""
    labelled, posted = unsettled(_labelled(members, links), posted)
    sizes = labelled.groupBy("label").agg(F.count("*").alias("times")).filter("times > 1")
    shared = labelled.join(sizes, "label", "left").withColumn("whole", F.when(F.col("times").isNotNull(), F.col("label"))).drop("times")
    grouped = materialize(in_full_groups(shared, F.col("whole"), F.col("keys")[0], F.col("keys")[1]).drop("whole", "keys"), "group-members")
    groups = materialize(matrix(grouped), "group-matrix")
    pairs = materialize(_in_blocks(materialize(candidates(grouped, groups, posted), "group-candidates")), "group-blocks")
    queries = members.select(F.col("node").alias("query"), "tokens")
    spots = ["class", "group", "block"]
    passed = (_replicated(groups.select("class", "group", "union", "least"), pairs).groupBy(*spots)
              .cogroup(pairs.join(queries, "query").groupBy(*spots))
              .applyInArrow(_bound, "class int, group bigint, query bigint, query_n bigint, query_label bigint"))
    opened = _in_blocks(materialize(passed, "group-passed"))
    return (_replicated(grouped.select("class", "group", "node", "label", "tokens"), opened).groupBy(*spots)
            .cogroup(opened.join(queries, "query").groupBy(*spots)).applyInArrow(_open, "src long, dst long"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sketch = F.arrow_udf(_sketch, "struct<n: long, high: long, low: long, tokens: array<long>>")(F.col("text"))
    sketches = materialize(named.select("doc_id", sketch.alias("s")).select("doc_id", "s.*"), "group-sketches")
    classes = materialize(sketches.filter("high IS NOT NULL").groupBy("high", "low")
                          .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n")), "group-classes")
    posted = materialize(prefixes(sketches), "group-prefixes")
    left = posted.groupBy(F.col("node").alias("high")).agg(F.first("single").alias("single"))
    wanted = materialize(classes.join(left, "high"), "group-wanted")
    # One text per class gives its full set.  The rows of a repeated doc_id meet in one task and are told apart there.
    ids = wanted.select(F.xxhash64("first_id").alias("dealt"), "first_id", "high", "low", "n", "single").hint("shuffle_hash")
    texts = named.select(F.xxhash64("doc_id").alias("dealt"), "doc_id", "text").join(ids, "dealt").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    whole = F.arrow_udf(_whole, "struct<high: long, low: long, tokens: array<long>, keys: array<long>>")(F.col("text"))
    sets = (texts.select("dealt", "high", "low", "n", "single", whole.alias("w")).filter("high = w.high AND low = w.low")
            .groupBy("dealt", "high", "low").agg(*[F.first(c).alias(c.split(".")[-1]) for c in ("n", "single", "w.tokens", "w.keys")]))
    members = materialize(sets.select(F.col("high").alias("node"), "n", "single", "tokens", "keys", size_class(F.col("n")).alias("class")), "group-sets")
    first = materialize(merge_round(members, 0), "group-links")
    heads = _labelled(members.select("node", (F.col("single") / F.col("n")).alias("own")), first).groupBy("label").agg(F.min(F.struct("own", "node")).alias("head"))
    second = materialize(merge_round(members.join(heads.select("head.node"), "node", "left_semi"), 1), "group-links")
    merged = first.unionByName(second)
    links = merged.unionByName(materialize(search(members.drop("single"), posted, merged), "group-links"))
    labelled = _labelled(classes.select("high", "low", "first_id", F.col("high").alias("node")), links)
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named_classes = labelled.join(smallest, "label").select("high", "low", "component_id")
    answered = sketches.select("doc_id", F.col("n").alias("n_shingles"), "high", "low").join(named_classes, ["high", "low"], "left")
    return answered.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
