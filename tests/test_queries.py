"""Every registered query against its SQL answer over whole tables, at the smallest scale."""

import compare
import pytest

import __spark_entry__ as contract
from kinfold.plans import queries as catalog

SF = "/root/testdata/sf0.001"
QUERIES, ANSWERS = contract.queries(), contract.oracle_sql()
NO_SQL = {"ml_scorer"}  # iterative fit


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_an_answer():
    assert set(catalog.QUERIES) - set(ANSWERS) == NO_SQL and not set(ANSWERS) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_query_equals_sql(spark, con, name):
    assert compare.spark_rows(QUERIES[name](spark, SF)) == compare.sql_rows(con, ANSWERS[name])


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_learned_scorer_separates_the_labels(spark):
    """On pairs that took no part in the fit, true pairs rank above the others more often than not."""
    rows = QUERIES["ml_scorer"](spark, SF).collect()
    assert rows and all(0.0 <= r["match_probability"] <= 1.0 for r in rows)
    held = [r for r in rows if r["held_out"]]
    true, false = ([r["match_probability"] for r in held if r["is_match"] == label] for label in (True, False))
    if true and false:
        ranked = sum((t > f) + 0.5 * (t == f) for t in true for f in false) / (len(true) * len(false))
        assert ranked > 0.6
