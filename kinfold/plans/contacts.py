"""Multi-source contact records derived from the `customer` table.

One scan; every customer row yields its one to five source records in place,
with planted defects (see FIXTURES.md section 5).  The raw extracts give the
same records in each source's own layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.operators.ingest import to_canonical, union_sources
from kinfold.operators.quality import evaluate
from kinfold.operators.standardize import standardize
from kinfold.plans.customer import AS_OF, CUSTOMER
from kinfold.spec import EntitySpec, Source

# How a customer key becomes a person.
_CONSONANTS = "bcdfghjklmnprstvwyzx"
_PERSON = [
    {"a": "(k * 7919 + 104729) % 1000003", "b": "(k * 15485863 + 32452843) % 999983"},
    {
        "fn": f"""concat(upper(substring('{_CONSONANTS}', CAST(1 + a % 20 AS INT), 1)),
                  substring('aeiou', CAST(1 + (a div 20) % 5 AS INT), 1),
                  substring('{_CONSONANTS}', CAST(1 + (a div 100) % 20 AS INT), 1),
                  element_at(array('an', 'ita', 'esh', 'un', 'avi'), CAST(1 + (a div 2000) % 5 AS INT)))""",
        "ln": f"""concat(upper(substring('{_CONSONANTS}', CAST(1 + b % 20 AS INT), 1)),
                  substring('aeiou', CAST(1 + (b div 20) % 5 AS INT), 1),
                  element_at(array('rma', 'mar', 'sen', 'tti'), CAST(1 + (b div 100) % 4 AS INT)))""",
        "ph": "CAST(9000000000 + (a * 104729 + b) % 999999937 AS STRING)",
        "ad": """concat(CAST(1 + b % 99 AS STRING),
                 element_at(array(' Lake Rd', ' Palm St', ' Rose Apt', ' Hill Sec'), CAST(1 + a % 4 AS INT)))""",
        "ci": "element_at(array('Gurgaon', 'Bombay', 'Bangalore', 'Calcutta', 'Delhi'), CAST(1 + b % 5 AS INT))",
        "st": "element_at(array('Haryana', 'Maharashtra', 'Karnataka', 'West Bengal', 'Delhi'), CAST(1 + b % 5 AS INT))",
        "yy": "CAST(1950 + a % 50 AS STRING)",
        "mm": "lpad(CAST(1 + b % 12 AS STRING), 2, '0')",
        "dd": "lpad(CAST(1 + a % 28 AS STRING), 2, '0')",
    },
    {"em": "concat(lower(fn), '.', lower(ln), CAST(k AS STRING), '@example.com')",
     "dash": "concat('+91-', substring(ph, 1, 5), '-', substring(ph, 6, 5))"},
]

_FIELDS = ["source_id", "source_record_id", "full_name", "email", "phone", "address_line", "city", "state",
           "country", "date_of_birth", "source_updated_at"]

# Fixed values: (condition, the eleven field expressions) per planted record.
_RECORDS = [
    ("true",
     ["'CRM'", "concat('C', k)", "concat(fn, ' ', ln)", "CASE WHEN k % 50 = 7 THEN replace(em, '@', '[at]') ELSE em END",
      "dash", "ad", "ci", "st", "'India'", "concat(CASE WHEN k % 60 = 11 THEN '2091' ELSE yy END, '-', mm, '-', dd)",
      "'2026-06-01'"]),
    ("k % 70 = 13",
     ["'CRM'", "concat('C', k)", "concat(fn, ' ', ln)", "em", "dash", "ad", "ci", "st", "'India'",
      "concat(yy, '-', mm, '-', dd)", "'2026-06-15'"]),
    ("k % 2 = 0",
     ["'WEB'", "concat('U', k)", "CASE WHEN k % 90 != 20 THEN concat(' ', lower(fn), '  ', lower(ln), ' ') END",
      """CASE WHEN k % 100 = 22 THEN NULL WHEN k % 80 = 18 THEN concat('new', k, '@example.org')
         ELSE upper(em) END""",
      """CASE WHEN k % 100 = 22 THEN NULL WHEN k % 40 = 4 OR k % 80 = 18 THEN CAST(8000000000 + k AS STRING)
         ELSE ph END""",
      "replace(ad, 'Rd', 'Road')", "ci", "st", "'IN'", "concat(dd, '/', mm, '/', yy)", "'2026-07-10'"]),
    ("k % 30 = 5",
     ["'WEB'", "concat('N', k)", "concat(fn, ' ', ln)", "concat('namesake', k, '@example.net')",
      "CAST(7000000000 + k AS STRING)", "'17 Mall Rd'", "ci", "st", "'IN'",
      "concat('15/06/', CAST(CAST(yy AS INT) + 3 AS STRING))", "'2026-07-11'"]),
    ("k % 3 = 0",
     ["'LEGACY'", "concat('L', k)", "upper(concat(fn, ' ', ln))", "CASE WHEN k % 9 != 0 THEN em END",
      "concat('0', ph)", "upper(ad)", "upper(ci)", "upper(st)", "'IND'", "concat(yy, mm, dd)", "'2024-01-20'"]),
]


def contact_records(customer: DataFrame, source_id: str | None = None) -> DataFrame:
    """All source records, or those of one source; works on a batch and on a streaming `customer` alike."""
    people = customer.select(F.col("c_custkey").alias("k"))
    for layer in _PERSON:
        people = people.select("*", *[F.expr(e).alias(n) for n, e in layer.items()])
    row = "named_struct({})".format
    planted = ", ".join(
        f"CASE WHEN {condition} THEN {row(', '.join(f'{n!r}, CAST({e} AS STRING)' for n, e in zip(_FIELDS, values)))} END"
        for condition, values in _RECORDS if source_id in (None, values[0].strip("'")))
    return people.select(F.expr(f"inline(array_compact(array({planted})))"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").repartition("c_custkey")


def extract(customer: DataFrame, source: Source) -> DataFrame:
    """The records of one source in that source's own column names."""
    return contact_records(customer, source.source_id).select(
        *[F.col(canonical).alias(c) for c, canonical in source.field_map.items()])


def landed(customer: DataFrame, batch_id: str = "b1", spec: EntitySpec = CUSTOMER) -> DataFrame:
    return union_sources([to_canonical(extract(customer, s), s, spec, batch_id, AS_OF) for s in spec.sources])


def bronze(spark: SparkSession, sf_dir: str, batch_id: str = "b1") -> DataFrame:
    return landed(customers(spark, sf_dir), batch_id)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(bronze(spark, sf_dir), CUSTOMER)


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(silver(spark, sf_dir), CUSTOMER.rules, AS_OF)
