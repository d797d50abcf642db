"""Other entities through the same operators: parts, documents, suppliers, orders, events.

Only specs and projections live here; no operator knows an entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.operators.ingest import record_uid
from kinfold.spec import EntitySpec

# Items of a catalogue: fuzzy names within brand or within type and size.
PART = EntitySpec.parse({
    "entity": "part",
    "attributes": ["p_name", "p_brand", "p_type", "p_size"],
    "standardization": {
        "p_name": [{"transform": "trim"}, {"transform": "collapse_whitespace"}, {"transform": "title_case"}],
        "p_type": [{"transform": "lower_case"}],
    },
    "rules": [
        {"rule_id": "P001", "rule_type": "not_null", "column": "p_name", "severity": "ERROR",
         "description": "Part needs a name"},
        {"rule_id": "P002", "rule_type": "expression", "expression": "CAST(p_size AS INT) BETWEEN 1 AND 45",
         "severity": "WARN", "description": "Size within the catalogue range"},
    ],
    "matching": {
        "blocking": [
            {"name": "brand", "expr": "concat('B|', p_brand)", "columns": ["p_brand"]},
            {"name": "kind", "expr": "concat('K|', p_type, '|', p_size)", "columns": ["p_type", "p_size"]},
        ],
        "deterministic": [["p_name", "p_brand", "p_type", "p_size"]],
        "features": [
            {"attribute": "p_name", "method": "token_sort_ratio", "weight": 0.5},
            {"attribute": "p_brand", "method": "exact", "weight": 0.2},
            {"attribute": "p_type", "method": "exact", "weight": 0.2},
            {"attribute": "p_size", "method": "exact", "weight": 0.1},
        ],
        "thresholds": {"auto_match": 0.85, "review": 0.75},
        "conflict_columns": ["p_type"],
    },
    "survivorship": {"p_name": ["non_null_longest"], "p_size": ["most_recent", "source_precedence"]},
})

# Texts from many sources: equal after case and white space are normalized.
DOCUMENT = EntitySpec.parse({
    "entity": "document",
    "attributes": ["text", "lang"],
    "standardization": {
        "text": [{"transform": "lower_case"}, {"transform": "collapse_whitespace"}, {"transform": "trim"}],
    },
    "matching": {
        "blocking": [{"name": "lang", "expr": "lang", "columns": ["lang"]}],
        "deterministic": [["text", "lang"]],
        "features": [{"attribute": "lang", "method": "exact", "weight": 0.1}],
        "thresholds": {"auto_match": 0.85, "review": 0.65},
    },
    "survivorship": {"text": ["source_precedence"], "lang": ["source_precedence"]},
})

ORDER_RULES = [
    {"rule_id": "O001", "rule_type": "domain", "column": "o_orderstatus", "allowed_values": ["O", "F"],
     "severity": "WARN", "description": "Order is open or finished"},
    {"rule_id": "O002", "rule_type": "expression", "expression": "o_totalprice > 1000", "severity": "ERROR",
     "description": "Order has a plausible total"},
    {"rule_id": "O003", "rule_type": "unique", "columns": ["o_orderkey"], "severity": "ERROR",
     "description": "Order key is unique"},
    {"rule_id": "O004", "rule_type": "reference", "column": "o_custkey", "reference": "customer",
     "reference_column": "c_custkey", "severity": "ERROR", "description": "Customer exists"},
    {"rule_id": "O005", "rule_type": "regex", "column": "o_orderpriority", "pattern": "^[1-3]-", "severity": "WARN",
     "description": "Priority is urgent to medium"},
    {"rule_id": "O006", "rule_type": "expression", "expression": "o_orderdate >= add_months({as_of}, -360)",
     "severity": "WARN", "description": "Order is not older than thirty years"},
]

LINE_RULES = [
    {"rule_id": "L001", "rule_type": "unique", "columns": ["l_orderkey", "l_linenumber"], "severity": "ERROR",
     "description": "Line number is unique within its order"},
    {"rule_id": "L002", "rule_type": "reference", "column": "l_orderkey", "reference": "orders",
     "reference_column": "o_orderkey", "severity": "ERROR", "description": "Order exists"},
    {"rule_id": "L003", "rule_type": "expression", "expression": "l_quantity BETWEEN 1 AND 45", "severity": "WARN",
     "description": "Quantity within the usual range"},
    {"rule_id": "L004", "rule_type": "domain", "column": "l_returnflag", "allowed_values": ["A", "N"],
     "severity": "WARN", "description": "Line was not returned"},
]

TURN_RULES = [
    {"rule_id": "T001", "rule_type": "unique", "columns": ["conv_id", "turn"], "severity": "ERROR",
     "description": "A turn occurs once in its conversation"},
    {"rule_id": "T002", "rule_type": "domain", "column": "role", "allowed_values": ["user", "assistant"],
     "severity": "WARN", "description": "Speaker is user or assistant"},
    {"rule_id": "T003", "rule_type": "expression", "expression": "length(text) > 0", "severity": "ERROR",
     "description": "Turn has text"},
]


def part_records(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return part.select(
        record_uid(F.lit("PART"), key).alias("record_uid"), F.lit("PART").alias("source_id"),
        key.alias("source_record_id"), F.lit("b1").alias("batch_id"), F.lit(1).alias("trust_rank"),
        F.lit(None).cast("string").alias("source_updated_at"),
        "p_name", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))


def document_records(documents: DataFrame) -> DataFrame:
    key = F.col("doc_id").cast("string")
    return documents.select(
        record_uid(F.col("source"), key).alias("record_uid"), F.col("source").alias("source_id"),
        key.alias("source_record_id"), F.lit("b1").alias("batch_id"),
        # sources are ranked by their number
        F.regexp_replace("source", "[^0-9]", "").cast("int").alias("trust_rank"),
        F.lit(None).cast("string").alias("source_updated_at"), "text", "lang")


def supplier_records(supplier: DataFrame) -> DataFrame:
    """Suppliers with their nation as a code that a reference table resolves."""
    return supplier.select("s_suppkey", "s_name", F.concat(F.lit("n"), F.col("s_nationkey")).alias("s_nation"))


def change_feed(events: DataFrame) -> DataFrame:
    """Events as a change feed on users: sign-ups insert, errors delete, everything else updates."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return events.select("user_id", "ts", "event_id", op.alias("op"), "event_type", "value")
