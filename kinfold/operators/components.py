"""Connected components as DataFrame rounds (alternating large-star / small-star).

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014),
rooted at the largest vertex.  Both star steps are a grouped maximum (combined
before the shuffle) joined back to the edges, so a node with a third of all
edges is never gathered in one task: its edges stay spread over the join,
which adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.session import drop_stage, materialize, read_stage, write_stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node to the node's largest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    root = both.groupBy("src").agg(F.max("dst").alias("top")).select("src", F.greatest("src", "top").alias("root"))
    return both.join(root, "src").filter("dst < src").select(F.col("dst").alias("src"), F.col("root").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its larger neighbours to the largest of them."""
    root = edges.groupBy("src").agg(F.max("dst").alias("root"))
    moved = (edges.join(root, "src").filter("dst != root")
             .select(F.col("dst").alias("src"), F.col("root").alias("dst")))
    return moved.unionByName(root.withColumnRenamed("root", "dst")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Is every node either a root or linked once, straight to a root?  One aggregation, one row back."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("vertex"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("dst").alias("vertex"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    degree = ends.groupBy("vertex").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degree.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(vertex, component) for every vertex on an edge; component = its largest vertex.

    Input columns `src`, `dst` of any orderable type.  Duplicate, reversed and
    self edges are allowed; vertices without another vertex are left out.  The rounds
    run on numbers in the order of the vertices, an eighth of the size of a uid.
    """
    spark = edges.sparkSession
    given = materialize(edges.filter("src != dst").select("src", "dst").distinct(), "edges")
    ends = given.select(F.explode(F.array("src", "dst")).alias("vertex")).distinct()
    # Numbers grow with partition and row of a sorted table; written once, they stay what they are.
    numbers = materialize(ends.orderBy("vertex").withColumn("number", F.monotonically_increasing_id()), "vertices")
    for end in ("src", "dst"):
        given = given.join(numbers.select(F.col("vertex").alias(end), F.col("number").alias(f"{end}_number")), end).drop(end)
    state = given.select(F.least("src_number", "dst_number").alias("src"), F.greatest("src_number", "dst_number").alias("dst")).distinct()
    path = write_stage(state, "edges")
    state = read_stage(state, path)
    for _ in range(max_rounds):
        if _settled(state):
            return _named(state, numbers)
        after = _small_star(_large_star(state))
        before, path = path, write_stage(after, "edges")
        state = read_stage(after, path)
        drop_stage(spark, before)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _named(settled: DataFrame, numbers: DataFrame) -> DataFrame:
    """Numbers back to vertices: members by their own number, then components by theirs."""
    roots = settled.select(F.col("dst").alias("number"), F.col("dst").alias("top")).distinct()
    placed = settled.select(F.col("src").alias("number"), F.col("dst").alias("top")).unionByName(roots)
    names = roots.select("top").join(numbers.select(F.col("number").alias("top"), F.col("vertex").alias("component")), "top")
    return placed.join(numbers, "number").join(names, "top").select("vertex", "component")
