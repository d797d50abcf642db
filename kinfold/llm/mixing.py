"""Mixing sources to target weights by entropy balancing.  DataFrame operations only.

Each source has a token target.  Its document rates r are the solution of

    minimise  relative entropy of r within the box [0, 3] around one copy each
    subject to  sum(size * r) = target

whose dual is convex in one multiplier per source and whose rates are
exponentially tilted: r = 3 / (1 + 2 exp(-lambda * size / scale)).  Newton
iterations solve all duals at once.  They run on the histogram of sizes per
source (one combinable aggregation of the documents), not on documents, and a
bracket around every multiplier keeps each step safe.

Rates become copies by error diffusion: in groups of about `GROUP` documents of
one source, chosen by hash, documents go from large to small and each is rounded
up or down, whichever leaves the group's running total nearer to its wanted
one.  So a hot source is many small groups, and a group's total is off by about
its smallest documents.

Sums are exact decimals, so their order does not matter and reruns agree.

Defined results: a null or empty text has size 0 and no tokens; a null source
is one source, last in order; a source without tokens has target 0 and rate 0;
repeated rows are documents of their own and may be rounded differently, every
row returned; an empty table gives no rows; `mixture` passes all columns on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.session import drop_stage, materialize, read_stage, write_stage

WEIGHTS = (5, 2, 1)
MOST = 3
GROUP = 500
NEWTON_ROUNDS = 60
TOLERANCE = 1e-9

_EXACT = "decimal(38,9)"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def _ranked(totals: DataFrame) -> DataFrame:
    """`totals` with `place`: 0, 1, ... by source in code-point order, null last.

    Sources are sorted across tasks; a task ranks its own and adds the number of
    sources before it, so no task sees all of them.
    """
    # A source is text of any length, so a leading digit puts null behind every text.
    keyed = totals.withColumn("order_key", F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))))
    parts = materialize(keyed.repartitionByRange("order_key").withColumn("part", F.spark_partition_id()), "mix-sources")
    # One row per task of the sort above, whatever the number of sources.
    before = (parts.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    inside = Window.partitionBy("part").orderBy("order_key")
    return (parts.join(before, "part").withColumn("place", F.col("before") + F.row_number().over(inside) - 1)
            .drop("part", "before", "order_key"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    All sizes are shared by weight; a source stops at MOST times its size and the
    excess is shared again among the others, until none is above.  The level per
    unit of weight rises with every round and each round fixes a source at
    least; a round is one aggregate of two numbers.
    """
    places = F.array(*[F.lit(w).cast("double") for w in weights])
    named = materialize(_ranked(totals).withColumn(
        "weight", F.element_at(places, (F.col("place") % len(weights) + 1).cast("int"))), "mix-weights")
    level, fixed = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level > MOST * F.col("source_size")
        at = named.agg(F.sum("source_size").alias("size"), F.count_if(full).alias("n"), F.count("*").alias("sources"),
                       F.sum(F.when(full, MOST * F.col("source_size")).otherwise(0)).alias("used"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not at["sources"] or at["n"] == fixed or not at["weight"]:
            level = level or 0.0
            break
        fixed, level = at["n"], (at["size"] - at["used"]) / at["weight"]
    most = (MOST * F.col("source_size")).cast("double")
    return named.select("source", "source_size", F.least(most, F.col("weight") * F.lit(level)).alias("target"))


def rate(multiplier: Column, size: Column, scale: Column) -> Column:
    """Tilted rate within 0..MOST; 1 at multiplier 0."""
    return MOST / (1 + (MOST - 1) * F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), multiplier * size / scale))))


def multipliers(histogram: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, scale, multiplier): Newton on the dual of every source at once.

    `histogram` has (source, size, n), `wanted` (source, source_size, target).
    Sources at 0 or at MOST times their size need no multiplier.
    """
    open_ = (wanted.filter((F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size")))
             .join(histogram.groupBy("source").agg(F.sum("n").alias("docs")),
                   wanted["source"].eqNullSafe(histogram["source"])).drop(histogram["source"]))
    state = open_.select("source", "target", (F.col("source_size") / F.col("docs")).alias("scale"), F.lit(0.0).alias("multiplier"),
                         F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"))
    path = write_stage(state, "mix-dual")
    state = read_stage(state, path)
    sizes = materialize(histogram.filter("size > 0").withColumnRenamed("source", "of_source"), "mix-histogram")
    for _ in range(NEWTON_ROUNDS):
        if state.filter("NOT done").isEmpty():
            break
        met = state.filter("NOT done").join(sizes, F.col("source").eqNullSafe(F.col("of_source")))
        size = F.col("size").cast("double")
        r = rate(F.col("multiplier"), size, F.col("scale"))
        x = size / F.col("scale")
        sums = met.groupBy(F.col("source").alias("at_source")).agg(
            F.sum((F.col("n") * size * r).cast(_EXACT)).cast("double").alias("tokens"),
            F.sum((F.col("n") * size * x * r * (1 - r / MOST)).cast(_EXACT)).cast("double").alias("slope"))
        here = state.join(sums, F.col("source").eqNullSafe(F.col("at_source")), "left")
        over = F.col("tokens") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("multiplier"))
        high = F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") - F.try_divide(F.col("tokens") - F.col("target"), F.col("slope"))
        inside = (step > low) & (step < high)
        # Outside the bracket: halve it, or double the multiplier while a side is still unbounded.
        wide = F.when(high >= 1e6, F.greatest(F.lit(1.0), 2 * low)).when(low <= -1e6, F.least(F.lit(-1.0), 2 * high))
        close = F.abs(F.col("tokens") - F.col("target")) <= TOLERANCE * F.col("target")
        after = here.select(
            "source", "target", "scale",
            F.when(F.col("done") | close, F.col("multiplier"))
            .otherwise(F.when(inside, step).otherwise(F.coalesce(wide, (low + high) / 2))).alias("multiplier"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | F.coalesce(close, F.lit(True))).alias("done"))
        before, path = path, write_stage(after, "mix-dual")
        state = read_stage(after, path)
        drop_stage(state.sparkSession, before)
    return state.select("source", "scale", "multiplier")


def _rounded(docs: Column) -> Column:
    """Copies of a group's (size, rate, ...) structs, largest first: error diffusion over their sizes."""
    def next_one(acc: Column, doc: Column) -> Column:
        wanted = acc["wanted"] + doc["size"] * doc["rate"]
        least = F.floor(doc["rate"])
        up = (doc["rate"] > least) & (2 * (wanted - acc["taken"] - least * doc["size"]) > doc["size"])
        n = (least + F.when(up, 1).otherwise(0)).cast("int")
        return F.struct(wanted.alias("wanted"), (acc["taken"] + n * doc["size"]).alias("taken"),
                        F.concat(acc["copies"], F.array(n)).alias("copies"))
    start = F.struct(F.lit(0.0).alias("wanted"), F.lit(0).cast("long").alias("taken"),
                     F.array().cast("array<int>").alias("copies"))
    return F.aggregate(docs, start, next_one)["copies"]


def allot(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(row, size, source_size, target, rate, copies) from (row, source, size).

    `row` is any struct without maps; it travels with its document, so nothing
    is joined back and rows need no key.
    """
    histogram = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    wanted = materialize(targets(totals.select("source", "source_size"), weights), "mix-targets")
    solved = multipliers(histogram, wanted).select(F.col("source").alias("s1"), "scale", "multiplier")
    counted = totals.select(F.col("source").alias("s2"), "docs")
    plan = materialize(wanted.join(solved, F.col("source").eqNullSafe(F.col("s1")), "left")
                       .join(counted, F.col("source").eqNullSafe(F.col("s2")))
                       .select(F.col("source").alias("of_source"), "source_size", "target", "scale", "multiplier", "docs"), "mix-plan")
    tilted = F.round(rate(F.col("multiplier"), F.col("size").cast("double"), F.col("scale")), 12)
    rated = sized.join(plan, F.col("source").eqNullSafe(F.col("of_source"))).withColumn(
        "rate", F.when((F.col("size") == 0) | (F.col("target") <= 0), 0.0)
        .when(F.col("multiplier").isNull(), float(MOST)).otherwise(tilted)).withColumn("spot", F.xxhash64("row"))
    group = F.pmod("spot", F.greatest(F.lit(1), F.ceil(F.col("docs") / GROUP)))
    grouped = rated.groupBy("source", "source_size", "target", group.alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("size", "spot", "rate", "row")), asc=False).alias("docs"))
    each = grouped.select("source_size", "target", F.inline(F.arrays_zip(
        F.col("docs").alias("doc"), _rounded(F.transform("docs", lambda d: F.struct(d["size"], d["rate"]))).alias("copies"))))
    return each.select("doc.row", "doc.size", "source_size", "target", "doc.rate", "copies")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: size, its source's size and target, the words taken, copies and rate."""
    sized = docs.select(F.struct(F.col(doc_id).alias("doc_id")).alias("row"), F.col(source).alias("source"),
                        size_of(F.col(text)).alias("size"))
    return allot(sized).select("row.doc_id", "size", "source_size", "target",
                               (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def mixture(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Every document as often as the mix takes it, with all its columns."""
    columns = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text, source = (f"c{columns.index(c)}" for c in (text, source))
    sized = inner.select(F.struct(*inner.columns).alias("row"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    taken = allot(sized).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return taken.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)])
