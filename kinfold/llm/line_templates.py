"""Line dedup by a log-template tree.  DataFrame operations only.

A line's words are runs of characters other than U+0020 and U+0009 to U+000D,
with every digit run read as 0 (in lines with letters and more than `DEPTH` words).  The tree has fixed depth: number of words, then
the first `DEPTH` words.  Within a leaf that several documents reach, the words
vote per position; the winners are the leaf's template.  A line follows it if at
least `SIMILAR` of its words behind the leading ones equal the template's and one
of all equal words has a letter, so the other positions are variable fields.  The lines that do not are parted by their words at the place where most
lines of the leaf agree (words that no other line has there stay together), and
each part votes again, until no part can agree.  A line that follows nothing is a
template of its own (its whole sequence of words).  A template that occurs in two documents or more recurs: its
lines are dropped from all documents but the first (smallest doc_id).

Texts are read twice: once for a hash per word of each line, once to drop.
Votes and counts are combinable aggregates on (leaf, position, word), never a
gathered leaf, so a line found in a third of all documents is like any other.

Lines of at most `DEPTH` words or without a letter recur only by their
exact words, digits included.  Lines without a word never recur.  Lines are compared within the whole
corpus, without caps.

Defined results: a null text has no lines and stays null; an empty text stays
empty; a text that loses no line is returned unchanged, otherwise its remaining
lines are joined by line feeds (empty if none is left); repeats inside one
document are not dropped; repeated rows (equal doc_id and text) are one document,
each returned alike; a null doc_id comes before all others; an empty table gives
no rows.  `dedup` passes all columns on, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.session import materialize

DEPTH = 4
SIMILAR = 0.8

_SPACE = r"[\x20\x09-\x0D]+"
LETTER = r"\p{L}"
WORDED = r"[^\x20\x09-\x0D]"


def _bare(line: Column) -> Column:
    """Words parted by one space. Most lines are so already; looking for other white space costs less than replacing it."""
    other = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in ("  ", "\t", "\n", "\v", "\f", "\r")])
    return F.trim(F.when(other, F.regexp_replace(line, _SPACE, " ")).otherwise(line))


def _exact(bare: Column) -> Column:
    """Words are one more than spaces: counted in bytes, without splitting."""
    spaces = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "), F.lit("")))
    return (spaces < DEPTH) | ~bare.rlike(LETTER)


def parsed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, doc_id, line, leaf, whole, words) of every line with a word.

    `doc` names the row by doc_id and text, `whole` hashes the words, `words` has
    31 bits of a 64-bit hash per position and a last bit that says whether the word has
    a letter or stands in a line whose leading words have one.  Two different words at
    one place pass for equal with probability 2 ** -31.
    """
    # Named before its lines are dealt out, so a text is hashed once and no line carries it.
    named_docs = docs.select(F.xxhash64(doc_id, text).alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    lines = named_docs.select("doc", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    bare = lines.filter(F.col("content").rlike(WORDED)).withColumn("bare", _bare(F.col("content")))
    split = bare.withColumn("w", F.split(F.when(_exact(F.col("bare")), F.col("bare"))
                                         .otherwise(F.regexp_replace("bare", "[0-9]+", "0")), " "))
    lettered = F.array_join(F.slice("w", 1, DEPTH), " ").rlike(LETTER)

    def named(x: Column) -> Column:
        return F.shiftright(F.xxhash64(x), 32).cast("int")
    # Words are looked at one by one only where the leading ones have no letter.
    words = (F.when(lettered, F.transform("w", lambda x: named(x).bitwiseOR(1)))
             .otherwise(F.transform("w", lambda x: F.when(x.rlike(LETTER), named(x).bitwiseOR(1)).otherwise(named(x).bitwiseAND(-2)))))
    return split.select("doc", "doc_id", "line", F.xxhash64(F.size("w"), F.slice("w", 1, DEPTH)).alias("leaf"),
                        F.xxhash64("w").alias("whole"), words.alias("words"))


def _follows(words: Column, template: Column) -> Column:
    """Enough equal words behind the leading ones, which are equal in a leaf, and an equal word with a letter (odd)."""
    equal = F.aggregate(F.zip_with(words, template, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    constant = F.exists(F.zip_with(words, template, lambda a, b: (a == b) & (a % 2 != 0)), lambda x: x)
    return (equal - DEPTH >= SIMILAR * (F.size(words) - DEPTH)) & constant


def templates(forms: DataFrame) -> DataFrame:
    """(leaf, whole, found): the template of each form that follows one, from (leaf, whole, words).

    A round votes in all parts of all leaves at once.  Each part loses the forms
    that follow its template or is split, so rounds end.
    """
    open_, found = forms.withColumn("part", F.col("leaf")), None
    while True:
        cells = open_.select("part", F.posexplode("words").alias("place", "word"))
        votes = cells.groupBy("part", "place", "word").agg(F.count("*").alias("n"))
        places = votes.groupBy("part", "place").agg(F.max(F.struct("n", "word")).alias("top"), F.sum("n").alias("size"))
        # The template as one array per part: its length is the leaf's number of words.
        agree = (F.col("top.n") > 1) & (F.col("top.n") < F.col("size"))
        template = places.groupBy("part").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "top.word"))), lambda x: x["word"]).alias("template"),
            F.max(F.when(agree, F.struct(F.col("top.n").alias("n"), (-F.col("place")).alias("back"))))["back"].alias("back"),
            F.max("size").alias("size")).filter("size > 1")
        met = open_.join(template, "part").withColumn("follows", _follows(F.col("words"), F.col("template")))
        judged = materialize(met.select(
            "leaf", "whole", F.when(F.col("follows"), F.xxhash64(F.lit("template"), "part")).alias("found"), "part", "back",
            F.when(~F.col("follows"), F.get("words", -F.col("back"))).alias("own"),
            F.when(~F.col("follows") & F.col("back").isNotNull(), F.col("words")).alias("words")), "line-round")
        here = judged.filter("found IS NOT NULL").select("leaf", "whole", "found")
        found = here if found is None else found.unionByName(here)
        rest = judged.filter("words IS NOT NULL")
        if rest.isEmpty():
            return found
        common = rest.groupBy("part", "own").agg(F.count("*").alias("n")).filter("n > 1")
        open_ = rest.join(common, ["part", "own"], "left").select(
            "leaf", "whole", "words", F.xxhash64("part", "back", F.when(F.col("n").isNotNull(), F.col("own"))).alias("part"))


def clustered(lines: DataFrame) -> DataFrame:
    """(doc, doc_id, line, template) of the lines in leaves that several documents reach."""
    leaves = (lines.groupBy("leaf").agg(F.min("doc").alias("d1"), F.max("doc").alias("d2"), F.min("whole").alias("w1"),
                                        F.max("whole").alias("w2"))
              .filter("d1 != d2").select("leaf", (F.col("w1") != F.col("w2")).alias("varied")))
    shared = materialize(lines.join(leaves, "leaf"), "line-shared")
    # With fewer words no other form is similar enough.
    behind = F.size("words") - DEPTH
    forms = shared.filter(F.col("varied") & (behind - 1 >= SIMILAR * behind)).groupBy("leaf", "whole").agg(F.first("words").alias("words"))
    follows = templates(forms)
    return (shared.select("leaf", "whole", "doc", "doc_id", "line").join(follows, ["leaf", "whole"], "left")
            .select("doc", "doc_id", "line", F.coalesce("found", F.xxhash64("leaf", "whole")).alias("template")))


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, lines): the numbers of the lines that each document loses."""
    lines = clustered(materialize(parsed(docs, doc_id, text), "line-words"))
    lines = materialize(lines, "line-templates")
    recurring = (lines.groupBy("template").agg(F.min(F.struct("doc_id", "doc")).alias("first"), F.min("doc").alias("d1"),
                                               F.max("doc").alias("d2"))
                 .filter("d1 != d2").select("template", F.col("first.doc").alias("first_doc")))
    gone = lines.join(recurring, "template").filter("doc != first_doc")
    return gone.groupBy("doc").agg(F.collect_set("line").alias("lines"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str | None = None) -> DataFrame:
    """All rows and columns with recurring lines dropped from the text; `out` adds a struct of line counts."""
    columns = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    key, body = (f"c{columns.index(c)}" for c in (doc_id, text))
    gone = dropped_lines(inner, key, body).select(F.col("doc").alias("gone_doc"), "lines")
    # A column of its own: inside the lambda below, the text would be split again for every line that stays.
    joined = (inner.join(gone, F.xxhash64(key, body) == F.col("gone_doc"), "left")
              .withColumn("every", F.when(F.col("lines").isNotNull(), F.split(F.col(body), "\n"))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), F.col("lines"))
    cut = F.when(F.col("lines").isNull(), F.col(body)).otherwise(
        F.concat_ws("\n", F.transform(F.array_sort(stay), lambda i: F.element_at("every", i + 1))))
    ends = F.octet_length(body) - F.octet_length(F.replace(F.col(body), F.lit("\n"), F.lit("")))
    n = F.when(F.col(body).isNull(), 0).otherwise(ends + 1).cast("long")
    n_gone = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    kept = [(cut if c == body else F.col(c)).alias(name) for c, name in zip(inner.columns, columns)]
    added = [F.struct(n.alias("n_lines"), n_gone.alias("n_dropped")).alias(out)] if out else []
    return joined.select(*kept, *added)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its lines, how many were dropped, and the remaining text."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return dedup(slim, out="n").select("doc_id", "n.n_lines", "n.n_dropped", "text")
