"""Row checks of the data-quality engine: a rule in, a boolean Column out (true = pass).

`unique` and `reference` look beyond the row; `operators.quality` computes
their flag by aggregation and join and hands it to the same failure array.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# rule_type -> (required keys, optional keys)
RULE_KEYS: dict[str, tuple[set[str], set[str]]] = {
    "not_null": ({"column"}, set()),
    "regex": ({"column", "pattern"}, {"allow_null"}),
    "domain": ({"column", "allowed_values"}, {"allow_null"}),
    "expression": ({"expression"}, set()),
    "unique": ({"columns"}, set()),
    "reference": ({"column", "reference", "reference_column"}, {"allow_null"}),
}


def row_check(rule: Mapping, as_of: str) -> Column:
    kind = rule["rule_type"]
    if kind == "expression":
        return F.expr(rule["expression"].replace("{as_of}", f"DATE'{as_of}'"))
    value = F.col(rule["column"])
    if kind == "not_null":
        return value.isNotNull()
    passed = value.rlike(rule["pattern"]) if kind == "regex" else value.isin(*rule["allowed_values"])
    return or_null(passed, rule)


def or_null(passed: Column, rule: Mapping) -> Column:
    return (F.col(rule["column"]).isNull() | passed) if rule.get("allow_null") else passed
