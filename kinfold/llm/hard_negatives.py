"""Hard negatives by Fagin's threshold algorithm, exact.

A row is an integer vector (components floor(256 * x)), a score the integer inner
product with an anchor.  Rows are dealt to shards by a hash.  A shard keeps, per
dimension, its rows sorted by component: the sorted lists.  An anchor reads a list
from its top where its own component is positive and from its bottom where it is
negative, so every list starts at its largest contribution to the score.  A row
met in any list is fetched by position (random access) and scored exactly.  What
no list has shown yet scores at most the threshold: the sum of each list's next
contribution.  The lists are read where the threshold falls most for a given
number of reads, and reading stops once the threshold is strictly below the kth
score of every window (or, where fewer are found, below its lower end).  Ties
with the kth are therefore always met.

Two searches: an anchor's `POSITIVES` best rows of its label give the windows
[50 %, 95 %] of each positive score; then the `NEGATIVES` best rows of another
label inside each window.  Every shard answers for its rows, and the answers are
merged per anchor, so no task holds more than one shard and one block of anchors.
Shards are searched per label for positives and over all labels for negatives.

Rows equal in label and vector differ by id only, so of each such group only the
smallest `POSITIVES + 1` ids can be among anybody's first: the others are anchors,
but never answers.  That is exact, and a group of copies is a few rows.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; vectors are compared with those of their own length only,
empty ones score 0; rows equal in id, label and vector count once; "other rows"
have another id than the anchor; a window of a negative score is empty; a vector
whose integer squared length reaches 2**62 has no long score and fails the job
with a message; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.session import materialize

ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive score
SCALE = 256
SHARD_ROWS = 32_768     # rows of one shard at most, on average
ANCHOR_BLOCK = 8_192    # anchors that a task of one shard answers at once, on average
LEAST_SHARD = 2_048     # a shard is not made smaller to occupy more cores
RUN = 64                # rows of a list read at a time
_EXACT = 1 << 53        # sums below it are exact in double precision


def components(vector: Column) -> Column:
    """The integer components, or null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    length = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double") ** 2)
    huge = F.exists(vector, lambda x: F.abs(x.cast("double")) * SCALE >= 2.0 ** 31) | (length >= 2.0 ** 62)
    fits = F.when(huge, F.raise_error(F.lit("a vector is too long for integer scores that fit a long")).cast("array<bigint>"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.coalesce(fits, scaled))


class Lists:
    """The sorted lists of some rows; `order[d]` has the rows by component d, largest first."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows.astype(np.float64) if len(rows) and float((rows.astype(np.float64) ** 2).sum(1).max()) < _EXACT / 4 else rows
        self.n, self.dims = rows.shape
        self.order = np.argsort(-rows, axis=0, kind="stable").T.astype(np.int32).copy()
        # The next component at every run's start, from either end; one past the end repeats the last.
        starts = np.minimum(np.arange(0, self.n + RUN, RUN), self.n - 1)
        self.tops = np.take_along_axis(rows, self.order[:, starts].T, axis=0).T.astype(np.float64)
        self.bottoms = np.take_along_axis(rows, self.order[:, self.n - 1 - starts].T, axis=0).T.astype(np.float64)

    def plan(self, anchor: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The threshold before any read, the runs (dimension * runs + run) in the order of reading, and the threshold after each."""
        ends = np.where((anchor > 0)[:, None], self.tops, self.bottoms) * anchor[:, None]
        falls = ends[:, :-1] - ends[:, 1:]
        # A run may only be read after those before it, so it counts no more than the least of them; dimensions at 0 are never read.
        steady = np.minimum.accumulate(falls, axis=1)
        steady[anchor == 0] = -1.0
        order = np.argsort(-steady, axis=None, kind="stable")[:int((anchor != 0).sum()) * steady.shape[1]]
        # Whole numbers below 2**53 add up exactly; the margin covers rounding beyond, and is below one before it matters.
        first = float(ends[:, 0].sum()) + 2.0 ** -36 * float(np.abs(ends).max(axis=1, initial=0.0).sum())
        return first, order, first - np.cumsum(falls.ravel()[order])

    def read(self, runs: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """The rows of these runs."""
        at, run = np.divmod(runs, self.tops.shape[1] - 1)
        places = run[:, None] * RUN + np.arange(RUN)
        inside = places < self.n
        places = np.where((anchor[at] > 0)[:, None], places, self.n - 1 - places)
        return self.order[np.broadcast_to(at[:, None], places.shape)[inside], places[inside]]

    def scores(self, some: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        exact = self.rows.dtype == np.float64 and float((anchor.astype(np.float64) ** 2).sum()) < _EXACT / 4
        found = self.rows[some] @ (anchor.astype(np.float64) if exact else anchor)
        return found.astype(np.int64) if exact else (self.rows[some].astype(np.int64) @ anchor)


def threshold_search(lists: Lists, anchor: np.ndarray, bound) -> tuple[np.ndarray, np.ndarray]:
    """(row, score) of all rows met until the threshold is strictly below `bound(rows, scores)`.

    `bound` gives the smallest score at which an unseen row could still matter; it only rises as rows are met.
    """
    rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    threshold, order, after = lists.plan(anchor)
    if not len(order):  # an anchor of zeros: every score is 0
        return np.arange(lists.n), np.zeros(lists.n, np.int64)
    seen = np.zeros(lists.n, bool)
    done, step = 0, lists.dims
    while threshold >= (least := bound(rows, scores)) and len(rows) < lists.n and done < len(order):
        needed = int(np.searchsorted(-after, -least, "right")) + 1  # runs after which the threshold is below the bound as it is
        stop = min(len(order), done + step, max(needed, done + 1))
        fresh = np.zeros(lists.n, bool)
        fresh[lists.read(order[done:stop], anchor)] = True
        new = np.flatnonzero(fresh & ~seen)
        seen |= fresh
        rows, scores = np.concatenate([rows, new]), np.concatenate([scores, lists.scores(new, anchor)])
        threshold, done, step = float(after[stop - 1]), stop, 2 * step
    return rows, scores


def _kth(scores: np.ndarray, k: int):
    """The kth largest, or None where there are fewer."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None


def _first(rows, scores, ids, k):
    """The first k by score, then id."""
    return np.lexsort((ids[rows], -scores))[:k]


def _positives(lists: Lists, ids, anchor_id, anchor):
    mine = ids == anchor_id

    def bound(rows, scores):
        kth = _kth(scores[~mine[rows]], POSITIVES)
        return -math.inf if kth is None else kth
    rows, scores = threshold_search(lists, anchor, bound)
    other = ~mine[rows]
    rows, scores = rows[other], scores[other]
    best = _first(rows, scores, ids, POSITIVES)
    return rows[best], scores[best]


def window_ends(positive_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest score of each window; empty ones have the smallest above the largest."""
    return -((-LOW * positive_scores) // 100), (HIGH * positive_scores) // 100


def _negatives(lists: Lists, ids, usable, anchor, positive_scores):
    """Per distinct positive score, (rows, scores) of the first negatives in its window."""
    lows, highs = window_ends(positive_scores)
    open_ = lows <= highs

    def bound(rows, scores):
        allowed = scores[usable[rows]]
        ends = [low if (kth := _kth(allowed[(allowed >= low) & (allowed <= high)], NEGATIVES)) is None else kth
                for low, high in zip(lows[open_], highs[open_])]
        return min(ends, default=math.inf)
    rows, scores = threshold_search(lists, anchor, bound)
    allowed = usable[rows]
    rows, scores = rows[allowed], scores[allowed]
    out = []
    for low, high in zip(lows, highs):
        inside = (scores >= low) & (scores <= high)
        best = _first(rows[inside], scores[inside], ids, NEGATIVES)
        out.append((rows[inside][best], scores[inside][best]))
    return out


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _answers(rows, names) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _positive_task(held: pa.Table, asked: pa.Table) -> pa.Table:
    out = []
    if held.num_rows and asked.num_rows:
        dim = held.column("dim")[0].as_py()
        lists = Lists(_matrix(held.column("vector"), dim))
        ids = held.column("vec_id").to_numpy()
        anchors, anchor_ids = _matrix(asked.column("vector"), dim), asked.column("vec_id").to_numpy()
        for name, anchor_id, anchor in zip(asked.column("anchor").to_pylist(), anchor_ids, anchors):
            rows, scores = _positives(lists, ids, anchor_id, anchor)
            out += [(name, i, s) for i, s in zip(ids[rows].tolist(), scores.tolist())]
    return _answers(out, ["anchor", "vec_id", "score"])


def _negative_task(held: pa.Table, asked: pa.Table) -> pa.Table:
    out = []
    if held.num_rows and asked.num_rows:
        dim = held.column("dim")[0].as_py()
        lists = Lists(_matrix(held.column("vector"), dim))
        ids, labels = held.column("vec_id").to_numpy(), held.column("label").to_numpy()
        anchors = _matrix(asked.column("vector"), dim)
        for name, label, scores, anchor in zip(asked.column("anchor").to_pylist(), asked.column("label").to_pylist(),
                                               asked.column("scores").to_pylist(), anchors):
            wanted = np.array(sorted(set(scores)), np.int64)
            for positive, (rows, found) in zip(wanted.tolist(), _negatives(lists, ids, labels != label, anchor, wanted)):
                out += [(name, positive, i, s) for i, s in zip(ids[rows].tolist(), found.tolist())]
    return _answers(out, ["anchor", "positive_score", "vec_id", "score"])


def _meet(held: DataFrame, anchors: DataFrame, keys: list[str], shards: int, blocks: int, task, schema: str) -> DataFrame:
    """`task` on every shard with every block of anchors that has its keys; each row is in one shard, each anchor in one block."""
    parts = [*keys, "shard", "block"]
    tasks = 2 * shards * blocks
    rows = (held.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))))
    asked = (anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>"))))
    return (rows.repartition(tasks, *parts).groupBy(*parts)
            .cogroup(asked.repartition(tasks, *parts).groupBy(*parts)).applyInArrow(task, schema))


def _first_by(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each key over all shards, with `rank` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def taking_part(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, dim, vector) of the rows that take part, each once."""
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                           components(F.col(vector)).alias("vector")).filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return named.select("vec_id", "label", F.size("vector").alias("dim"), "vector").distinct()


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, positive_id, positive_score, rank, vec_id, score).

    `rows` has distinct (vec_id, label, dim, vector), `anchors` the same and a long `anchor` that names each.
    """
    copies = Window.partitionBy("label", "vector").orderBy("vec_id")
    held = materialize(rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= POSITIVES + 1).drop("copy"), "negative-rows")
    n, asked = held.count(), anchors.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(n / SHARD_ROWS), min(cores, math.ceil(n / LEAST_SHARD)))
    blocks = max(1, math.ceil(asked / ANCHOR_BLOCK))
    found = _meet(held, anchors, ["dim", "label"], shards, blocks, _positive_task, "anchor long, vec_id long, score long")
    positives = materialize(_first_by(found, ["anchor"], POSITIVES).select("anchor", F.col("vec_id").alias("positive_id"),
                                                                          F.col("score").alias("positive_score")), "negative-windows")
    windows = positives.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))  # POSITIVES at most
    found = _meet(held, anchors.join(windows, "anchor"), ["dim"], shards, blocks, _negative_task,
                  "anchor long, positive_score long, vec_id long, score long")
    best = _first_by(found, ["anchor", "positive_score"], NEGATIVES)
    return positives.join(best, ["anchor", "positive_score"])


def report(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Hard negatives of every anchor: ids divisible by `ANCHOR_EVERY`; labels of ids divisible by 7 move on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialize(taking_part(vectors, vec_id, vector, label).withColumn("label", moved), "negative-rows")
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0).withColumn("anchor", F.monotonically_increasing_id())
    anchors = materialize(anchors, "negative-anchors")  # written, so the names stay
    found = mine(rows, anchors).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
