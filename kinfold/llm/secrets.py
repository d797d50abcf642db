"""Secret scans: an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  A ledger
keeps the findings per (rule version, blob); a scan reads only the blobs that
the ledger lacks under the current rule version, once each, however many paths
or versions hold them.  Findings are joined back to all paths.

Defined results: a null text is an empty blob without findings; equal texts
share one ledger entry; repeated rows are returned as often as they come; a
null path is a path like any other; an empty table gives no rows.  Texts are
scanned whole.  Other columns of the input are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinfold.llm.arrow_text import filled
from kinfold.session import scratch_path

# The base rules, in listing order; `least` counts characters of the named group.
BASE_RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, False),
    ("hex", r"[0-9a-f]{24,}", 0, 24, False),
)
# Rules this operator adds; their spans come on top of the base ones.
ADDED_RULES = (
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, False),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1, False),
)
RULES = BASE_RULES + ADDED_RULES
BASE_KINDS = tuple(r[0] for r in BASE_RULES)

SPANS = "array<struct<kind string, start bigint, end bigint>>"
_LEDGER = f"rule_version string, blob string, spans {SPANS}"


def rule_version(rules=RULES) -> str:
    """Changes whenever a rule does, so a changed rule set scans every blob anew."""
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def spans_of(text: str, rules=RULES) -> list[dict]:
    """Findings of one text in order of start, then listing; code points, end exclusive."""
    found = []
    for order, (kind, pattern, group, least, any_case) in enumerate(rules):
        flags = re.ASCII | (re.IGNORECASE if any_case else 0)
        for m in re.compile(pattern, flags).finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [{"kind": kind, "start": start, "end": end} for start, _, kind, end in sorted(found)]


def _scan(rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [spans_of(text, rules) for text in filled(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(found, kind)], ["blob", "spans"])
    return run


def addressed(versions: DataFrame, path: str, text: str) -> DataFrame:
    """(path, blob, text) of every version."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return versions.select(F.col(path).alias("path"), F.sha2(whole, 256).alias("blob"), whole.alias("text"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none if it was never written."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def unseen(named: DataFrame, ledger: DataFrame, version: str) -> DataFrame:
    """(blob, text) of blobs without an entry under `version`, one text each.

    The rows to scan are picked on hashes; texts then meet the picked ones by
    (path, blob), so a blob with very many paths does not gather in one task.
    """
    known = ledger.filter(F.col("rule_version") == version).select("blob")
    picked = (named.groupBy("blob").agg(F.min(F.struct("path")).alias("first")).join(known, "blob", "left_anti")
              .select(F.col("blob").alias("picked_blob"), F.col("first.path").alias("picked_path")).hint("shuffle_hash"))
    same = (F.col("blob") == F.col("picked_blob")) & F.col("path").eqNullSafe(F.col("picked_path"))
    return named.join(picked, same, "left_semi").select("blob", "text")


def update_ledger(versions: DataFrame, ledger: str, path: str = "path", text: str = "text", rules=RULES) -> None:
    """Scan what the ledger lacks and append it."""
    version = rule_version(rules)
    named = addressed(versions, path, text)
    seen = read_ledger(versions.sparkSession, ledger)
    found = unseen(named, seen, version).mapInArrow(_scan(rules), f"blob string, spans {SPANS}")
    (found.select(F.lit(version).alias("rule_version"), "blob", "spans").dropDuplicates(["blob"])
     .write.mode("append").parquet(ledger))


def findings(versions: DataFrame, ledger: str | None = None, path: str = "path", text: str = "text",
             rules=RULES) -> DataFrame:
    """(path, blob, spans) for every version of every path, scanning only unseen blobs.

    Without `ledger` a fresh one below the shared folder is used.
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    update_ledger(versions, ledger, path, text, rules)
    mine = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version(rules)).select("blob", "spans")
    return addressed(versions, path, text).select("path", "blob").join(mine, "blob").select("path", "blob", "spans")


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined in their order."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(F.col("path").alias("doc_id"), *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), F.col("blob").alias("blob_sha256"))
