"""Named value transforms: Column in, Column out, NULL in gives NULL out.

A transform is registered under the name used in a spec; its keyword
arguments are the `params` of the rule.  All of them are built-in Spark
expressions, so a whole chain stays inside one generated projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

TRANSFORMS: dict[str, Callable[..., Column]] = {}

# Honorifics removed from names and the accepted e-mail form.
HONORIFICS = ("Mr", "Mrs", "Ms", "Dr", "Shri", "Smt")
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def transform(name: str):
    def register(fn: Callable[..., Column]):
        TRANSFORMS[name] = fn
        return fn

    return register


def apply_chain(column: Column, chain: Sequence[Mapping]) -> Column:
    """Fold the steps of one rule chain over a column."""
    return reduce(lambda c, step: TRANSFORMS[step["transform"]](c, **step.get("params", {})), chain, column)


@transform("trim")
def trim(value: Column) -> Column:
    return F.trim(value)


@transform("collapse_whitespace")
def collapse_whitespace(value: Column) -> Column:
    return F.regexp_replace(value, r"\s+", " ")


@transform("title_case")
def title_case(value: Column) -> Column:
    return F.initcap(F.lower(value))


@transform("lower_case")
def lower_case(value: Column) -> Column:
    return F.lower(value)


@transform("upper_case")
def upper_case(value: Column) -> Column:
    return F.upper(value)


@transform("digits_only")
def digits_only(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits) > 0, digits)


@transform("strip_titles")
def strip_titles(value: Column, titles: Sequence[str] = HONORIFICS) -> Column:
    """Drop one leading honorific (with or without a dot) that is followed by white space."""
    return F.regexp_replace(value, rf"^({'|'.join(map(re.escape, titles))})\.?\s+", "")


@transform("null_if_invalid_email")
def null_if_invalid_email(value: Column, pattern: str = EMAIL_PATTERN) -> Column:
    return F.when(value.rlike(pattern), value)


@transform("normalize_phone")
def normalize_phone(value: Column, country_code: str = "91", trunk_prefix: str = "0", national: int = 10) -> Column:
    """Cut a country code or trunk prefix when exactly a national number remains."""
    stripped = [
        F.when(value.startswith(prefix) & (F.length(value) == len(prefix) + national), F.right(value, F.lit(national)))
        for prefix in (country_code, trunk_prefix)
    ]
    return F.coalesce(*stripped, value)


@transform("expand_abbreviations")
def expand_abbreviations(value: Column, map: Mapping[str, str]) -> Column:
    return reduce(
        lambda c, item: F.regexp_replace(c, rf"\b{re.escape(item[0])}\b\.?", item[1].replace("$", r"\$")),
        map.items(), value)


@transform("reference_lookup")
def reference_lookup(value: Column, map: Mapping[str, str]) -> Column:
    """Case-insensitive lookup in a small fixed vocabulary; unknown values pass.

    Vocabularies that come as tables use `standardize.lookup_join`.
    """
    key = F.upper(value)
    return F.coalesce(*[F.when(key == k.upper(), F.lit(v)) for k, v in map.items()], value)


@transform("parse_date")
def parse_date(value: Column, formats: Sequence[str]) -> Column:
    """ISO text of the first format that parses; malformed text becomes NULL."""
    return F.date_format(F.coalesce(*[F.try_to_date(value, f) for f in formats]), "yyyy-MM-dd")
