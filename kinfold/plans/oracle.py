"""Independent SQL answers, in DuckDB's dialect, for the queries of this package.

Everything is computed the plain way: all pairs of a block, a window per
survivorship decision, a recursive closure per cluster.  Nothing is shared
with the Spark code.
"""

from __future__ import annotations

from kinfold.plans.customer import AS_OF

# The derived multi-source records (FIXTURES.md section 5).
RECORDS = """
WITH h AS (
  SELECT c_custkey AS k, (c_custkey * 7919 + 104729) % 1000003 AS a, (c_custkey * 15485863 + 32452843) % 999983 AS b FROM customer),
p AS (
  SELECT k,
    concat(upper(substring('bcdfghjklmnprstvwyzx', CAST(1 + a % 20 AS INT), 1)), substring('aeiou', CAST(1 + CAST(floor(a / 20) AS BIGINT) % 5 AS INT), 1),
           substring('bcdfghjklmnprstvwyzx', CAST(1 + CAST(floor(a / 100) AS BIGINT) % 20 AS INT), 1),
           CASE CAST(floor(a / 2000) AS BIGINT) % 5 WHEN 0 THEN 'an' WHEN 1 THEN 'ita' WHEN 2 THEN 'esh' WHEN 3 THEN 'un' ELSE 'avi' END) AS fn,
    concat(upper(substring('bcdfghjklmnprstvwyzx', CAST(1 + b % 20 AS INT), 1)), substring('aeiou', CAST(1 + CAST(floor(b / 20) AS BIGINT) % 5 AS INT), 1),
           CASE CAST(floor(b / 100) AS BIGINT) % 4 WHEN 0 THEN 'rma' WHEN 1 THEN 'mar' WHEN 2 THEN 'sen' ELSE 'tti' END) AS ln,
    CAST(9000000000 + (a * 104729 + b) % 999999937 AS STRING) AS ph,
    concat(CAST(1 + b % 99 AS STRING), CASE a % 4 WHEN 0 THEN ' Lake Rd' WHEN 1 THEN ' Palm St' WHEN 2 THEN ' Rose Apt' ELSE ' Hill Sec' END) AS ad,
    CASE b % 5 WHEN 0 THEN 'Gurgaon' WHEN 1 THEN 'Bombay' WHEN 2 THEN 'Bangalore' WHEN 3 THEN 'Calcutta' ELSE 'Delhi' END AS ci,
    CASE b % 5 WHEN 0 THEN 'Haryana' WHEN 1 THEN 'Maharashtra' WHEN 2 THEN 'Karnataka' WHEN 3 THEN 'West Bengal' ELSE 'Delhi' END AS st,
    CAST(1950 + a % 50 AS STRING) AS yy, lpad(CAST(1 + b % 12 AS STRING), 2, '0') AS mm, lpad(CAST(1 + a % 28 AS STRING), 2, '0') AS dd
  FROM h),
e AS (SELECT *, concat(lower(fn), '.', lower(ln), CAST(k AS STRING), '@example.com') AS em FROM p)
SELECT 'CRM' AS source_id, 1 AS trust_rank, concat('C', CAST(k AS STRING)) AS source_record_id, concat(fn, ' ', ln) AS full_name,
  CASE WHEN k % 50 = 7 THEN replace(em, '@', '[at]') ELSE em END AS email, concat('+91-', substring(ph, 1, 5), '-', substring(ph, 6, 5)) AS phone,
  ad AS address_line, ci AS city, st AS state, 'India' AS country,
  concat(CASE WHEN k % 60 = 11 THEN '2091' ELSE yy END, '-', mm, '-', dd) AS date_of_birth, '2026-06-01' AS source_updated_at FROM e
UNION ALL
SELECT 'CRM', 1, concat('C', CAST(k AS STRING)), concat(fn, ' ', ln), em, concat('+91-', substring(ph, 1, 5), '-', substring(ph, 6, 5)), ad, ci, st, 'India',
  concat(yy, '-', mm, '-', dd), '2026-06-15' FROM e WHERE k % 70 = 13
UNION ALL
SELECT 'WEB', 2, concat('U', CAST(k AS STRING)), CASE WHEN k % 90 = 20 THEN NULL ELSE concat(' ', lower(fn), '  ', lower(ln), ' ') END,
  CASE WHEN k % 100 = 22 THEN NULL WHEN k % 80 = 18 THEN concat('new', CAST(k AS STRING), '@example.org') ELSE upper(em) END,
  CASE WHEN k % 100 = 22 THEN NULL WHEN k % 40 = 4 OR k % 80 = 18 THEN CAST(8000000000 + k AS STRING) ELSE ph END,
  replace(ad, 'Rd', 'Road'), ci, st, 'IN', concat(dd, '/', mm, '/', yy), '2026-07-10' FROM e WHERE k % 2 = 0
UNION ALL
SELECT 'WEB', 2, concat('N', CAST(k AS STRING)), concat(fn, ' ', ln), concat('namesake', CAST(k AS STRING), '@example.net'), CAST(7000000000 + k AS STRING),
  '17 Mall Rd', ci, st, 'IN', concat('15/06/', CAST(CAST(yy AS INT) + 3 AS STRING)), '2026-07-11' FROM e WHERE k % 30 = 5
UNION ALL
SELECT 'LEGACY', 3, concat('L', CAST(k AS STRING)), upper(concat(fn, ' ', ln)), CASE WHEN k % 9 = 0 THEN NULL ELSE em END, concat('0', ph),
  upper(ad), upper(ci), upper(st), 'IND', concat(yy, mm, dd), '2024-01-20' FROM e WHERE k % 3 = 0
"""

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
ATTRIBUTES = ["full_name", "email", "phone", "address_line", "city", "state", "country", "date_of_birth"]
LAYOUT = {
    "CRM": ["cust_id", "full_name", "email_addr", "phone", "addr_line", "city", "state", "country", "dob", "updated_at"],
    "WEB": ["user_id", "name", "contact_email", "mobile", "street", "city_name", "region", "country_code", "birth_date",
            "modified_ts"],
    "LEGACY": ["CUST_NO", "CUST_NAME", "EMAIL", "TEL", "ADDR", "CITY", "ST", "CTRY", "BIRTH_DT", "LAST_UPD"],
}
CANONICAL = ["source_record_id", *ATTRIBUTES, "source_updated_at"]


def _title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: concat(upper(w[1]), w[2:])), ' ')"


def _lookup(x: str, pairs: dict[str, str]) -> str:
    return f"CASE upper({x}) " + " ".join(f"WHEN '{k.upper()}' THEN '{v}'" for k, v in pairs.items()) + f" ELSE {x} END"


def _squeeze(x: str) -> str:
    return rf"regexp_replace(trim({x}), '\s+', ' ', 'g')"


_digits = "nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '')"
_street = _title(_squeeze("address_line"))
for _short, _long in {"St": "Street", "Rd": "Road", "Apt": "Apartment", "Blk": "Block", "Sec": "Sector"}.items():
    _street = rf"regexp_replace({_street}, '\b{_short}\b\.?', '{_long}', 'g')"
_dates = ", ".join(f"try_strptime(date_of_birth, '{f}')" for f in
                   ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y", "%Y%m%d", "%d-%b-%Y"))

CLEAN = {
    "full_name": rf"regexp_replace({_title(_squeeze('full_name'))}, '^(Mr|Mrs|Ms|Dr|Shri|Smt)\.?\s+', '')",
    "email": f"CASE WHEN regexp_matches(lower(trim(email)), '{EMAIL}') THEN lower(trim(email)) END",
    "phone": f"""CASE WHEN length({_digits}) = 12 AND starts_with({_digits}, '91') THEN substring({_digits}, 3, 10)
        WHEN length({_digits}) = 11 AND starts_with({_digits}, '0') THEN substring({_digits}, 2, 10) ELSE {_digits} END""",
    "address_line": _street,
    "city": _lookup(_title("trim(city)"), {"Gurgaon": "Gurugram", "Bombay": "Mumbai", "Bangalore": "Bengaluru",
                                           "Calcutta": "Kolkata"}),
    "state": _lookup("upper(trim(state))", {"HARYANA": "HR", "DELHI": "DL", "MAHARASHTRA": "MH", "KARNATAKA": "KA",
                                            "UTTAR PRADESH": "UP", "WEST BENGAL": "WB"}),
    "country": _lookup("upper(trim(country))", {"INDIA": "IN", "IND": "IN", "BHARAT": "IN"}),
    "date_of_birth": f"strftime(coalesce({_dates}), '%Y-%m-%d')",
}
CHAINS = {
    "full_name": "trim|collapse_whitespace|title_case|strip_titles",
    "email": "trim|lower_case|null_if_invalid_email",
    "phone": "digits_only|normalize_phone",
    "address_line": "trim|collapse_whitespace|title_case|expand_abbreviations",
    "city": "trim|title_case|reference_lookup",
    "state": "trim|upper_case|reference_lookup",
    "country": "trim|upper_case|reference_lookup",
    "date_of_birth": "parse_date",
}

RULES = [
    ("DQ001", "ERROR", "Full name is mandatory", "full_name IS NOT NULL"),
    ("DQ002", "ERROR", "At least one contact identifier (email or phone) must exist", "email IS NOT NULL OR phone IS NOT NULL"),
    ("DQ003", "ERROR", "Email must be well-formed", f"email IS NULL OR regexp_matches(email, '{EMAIL}')"),
    ("DQ004", "WARN", "Phone must be a 10-digit national number", "phone IS NULL OR regexp_matches(phone, '^[6-9][0-9]{9}$')"),
    ("DQ005", "WARN", "Country must be in the ISO reference list (domain validation)",
     "country IS NULL OR country IN ('IN', 'US', 'GB', 'AE', 'SG')"),
    ("DQ006", "ERROR", "Date of birth must be a valid past date (business rule)",
     "date_of_birth IS NULL OR (date_of_birth > '1900-01-01' AND date_of_birth < '{as_of}')"),
    ("DQ007", "ERROR", "source_record_id must be unique within a source batch (duplicate key)", "copies = 1"),
    ("DQ008", "WARN", "Record freshness — source timestamp within last 3 years (timeliness)",
     "source_updated_at IS NULL OR TRY_CAST(source_updated_at AS DATE) >= CAST('{as_of}' AS DATE) - INTERVAL 36 MONTH"),
]


def _raw_json(source: str) -> str:
    fields = ", ".join(f"'{n}', {c}" for n, c in zip(LAYOUT[source], CANONICAL))
    return f"WHEN '{source}' THEN CAST(json_object({fields}) AS VARCHAR)"


def base(as_of: str = AS_OF) -> str:
    """records -> bronze -> std (raw values kept as raw_*) -> checked -> results, valid."""
    std = ", ".join(f"{expr} AS {a}" for a, expr in CLEAN.items())
    raw = ", ".join(f"{a} AS raw_{a}" for a in ATTRIBUTES)
    failures = ", ".join(
        f"CASE WHEN NOT coalesce({check.replace('{as_of}', as_of)}, false) THEN "
        f"{{'rule_id': '{rule}', 'severity': '{severity}', 'description': '{text}'}} END"
        for rule, severity, text, check in RULES)
    payload = " ".join(_raw_json(s) for s in LAYOUT)
    return f"""
records AS ({RECORDS}),
bronze AS (SELECT sha256(concat(source_id, '||', source_record_id)) AS record_uid, 'b1' AS batch_id,
             '{AS_OF} 00:00:00' AS ingest_ts, *, CASE source_id {payload} END AS raw_payload FROM records),
std AS (SELECT record_uid, source_id, source_record_id, batch_id, trust_rank, source_updated_at, raw_payload, {raw}, {std} FROM bronze),
keyed AS (SELECT *, count(*) OVER (PARTITION BY batch_id, source_id, source_record_id) AS copies FROM std),
failed AS (SELECT *, list_filter([{failures}], lambda f: f IS NOT NULL) AS dq_failures FROM keyed),
checked AS (SELECT *, CASE WHEN len(list_filter(dq_failures, lambda f: f.severity = 'ERROR')) > 0 THEN 'QUARANTINED'
              WHEN len(dq_failures) > 0 THEN 'VALID_WITH_WARNINGS' ELSE 'VALID' END AS dq_status FROM failed),
results AS (SELECT record_uid, source_id, source_record_id, batch_id, f.rule_id AS rule_id, f.severity AS severity,
              f.description AS description FROM (SELECT *, unnest(dq_failures) AS f FROM checked)),
valid AS (SELECT * FROM checked WHERE dq_status != 'QUARANTINED')"""


BLOCKS = """
blocks AS (
  SELECT record_uid, concat('N|', substring(letters, 1, 3)) AS block_key
  FROM (SELECT record_uid, nullif(regexp_replace(lower(full_name), '[^a-z]', '', 'g'), '') AS letters FROM valid) WHERE letters IS NOT NULL
  UNION SELECT record_uid, concat('P|', right(phone, 4)) FROM valid WHERE phone IS NOT NULL
  UNION SELECT record_uid, concat('E|', left(email, 4)) FROM valid WHERE email IS NOT NULL)"""

# All pairs of all blocks; LCS by a bit-vector recursion over distinct text pairs.
_CANDIDATES = BLOCKS + """,
cand AS (SELECT DISTINCT l.record_uid AS u1, r.record_uid AS u2 FROM blocks l JOIN blocks r
         ON l.block_key = r.block_key AND l.record_uid < r.record_uid)"""

_LCS = """,
lcs(a, b, i, v) AS (
  SELECT a, b, 0, (1::HUGEINT << length(a)::INT) - 1 FROM texts
  UNION ALL
  SELECT a, b, i + 1, ((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << length(a)::INT) - 1)
  FROM (SELECT *, coalesce(list_sum(list_transform(range(length(a)),
          lambda p: CASE WHEN a[p + 1] = b[i + 1] THEN 1::HUGEINT << p::INT ELSE 0::HUGEINT END)), 0)::HUGEINT AS m
        FROM lcs WHERE i < length(b))),
common AS (SELECT a AS ta, b AS tb, length(a) - bit_count(v) AS same_chars FROM lcs WHERE i = length(b))"""


def _tokens(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda t: length(t) > 0)"


PAIRS = _CANDIDATES + f""",
sides AS (SELECT record_uid, full_name, address_line, email, phone, date_of_birth, country,
            array_to_string(list_sort({_tokens('full_name')}), ' ') AS name_form, {_tokens('address_line')} AS words FROM valid),
joined AS (
  SELECT u1, u2, l.name_form AS n1, r.name_form AS n2,
    array_to_string(list_sort(list_filter(list_distinct(l.words), lambda t: NOT list_contains(r.words, t))), ' ') AS d1,
    array_to_string(list_sort(list_filter(list_distinct(r.words), lambda t: NOT list_contains(l.words, t))), ' ') AS d2,
    length(array_to_string(list_filter(list_distinct(l.words), lambda t: list_contains(r.words, t)), ' ')) AS common_len,
    coalesce(l.email = r.email, false) AS e, coalesce(l.phone = r.phone, false) AS p,
    coalesce(l.date_of_birth = r.date_of_birth, false) AS b,
    coalesce(l.date_of_birth != r.date_of_birth, false) OR coalesce(l.country != r.country, false) AS clash
  FROM cand JOIN sides l ON l.record_uid = u1 JOIN sides r ON r.record_uid = u2),
texts AS (SELECT DISTINCT n1 AS a, n2 AS b FROM joined WHERE n1 IS NOT NULL AND n2 IS NOT NULL
          UNION SELECT DISTINCT d1, d2 FROM joined WHERE d1 IS NOT NULL AND d2 IS NOT NULL)""" + _LCS + """,
measured AS (
  SELECT j.*, coalesce(CASE WHEN length(n1) + length(n2) = 0 THEN 1.0 ELSE 2.0 * cn.same_chars / (length(n1) + length(n2)) END, 0.0) AS sim_full_name,
    coalesce(CASE WHEN common_len > 0 AND (d1 = '' OR d2 = '') THEN 1.0
      WHEN common_len = 0 AND (d1 = '' OR d2 = '') THEN 0.0
      WHEN common_len = 0 THEN 1.0 - (length(d1) + length(d2) - 2 * ca.same_chars) / (length(d1) + length(d2))
      ELSE greatest(1.0 - (length(d1) + length(d2) - 2 * ca.same_chars) / (2 * (common_len + 1) + length(d1) + length(d2)),
                    1.0 - (1 + length(d1)) / (2 * common_len + 1 + length(d1)),
                    1.0 - (1 + length(d2)) / (2 * common_len + 1 + length(d2))) END, 0.0) AS sim_address_line,
    e::INT::DOUBLE AS sim_email, p::INT::DOUBLE AS sim_phone, b::INT::DOUBLE AS sim_date_of_birth, e OR (p AND b) AS det
  FROM joined j LEFT JOIN common cn ON cn.ta = n1 AND cn.tb = n2 LEFT JOIN common ca ON ca.ta = d1 AND ca.tb = d2),
scored AS (SELECT *, round(0.4::DOUBLE * sim_full_name + 0.25::DOUBLE * sim_address_line + 0.15::DOUBLE * sim_email
                           + 0.1::DOUBLE * sim_phone + 0.1::DOUBLE * sim_date_of_birth, 4) AS fuzzy FROM measured),
decided AS (SELECT *, CASE WHEN det THEN 1.0 ELSE fuzzy END AS score,
              CASE WHEN det THEN 'MATCH' WHEN clash THEN 'REJECTED_FP_GUARD' WHEN fuzzy >= 0.85 THEN 'MATCH'
                   WHEN fuzzy >= 0.65 THEN 'REVIEW' ELSE 'NO_MATCH' END AS decision FROM scored),
prof AS (SELECT record_uid, min(record_uid) OVER w AS first_uid, max(record_uid) OVER w AS last_uid FROM valid
         WINDOW w AS (PARTITION BY full_name, phone, email, date_of_birth, address_line, country)),
named_pairs AS (
  SELECT u1, u2, CASE WHEN a.first_uid = z.first_uid THEN a.first_uid ELSE least(a.first_uid, z.first_uid) END AS record_uid_1,
    CASE WHEN a.first_uid = z.first_uid THEN a.last_uid ELSE greatest(a.first_uid, z.first_uid) END AS record_uid_2,
    score, decision, sim_full_name, sim_address_line, sim_email, sim_phone, sim_date_of_birth, a.first_uid = z.first_uid AS same
  FROM decided JOIN prof a ON a.record_uid = u1 JOIN prof z ON z.record_uid = u2 WHERE NOT det AND fuzzy >= 0.65),
fuzzy_pairs AS (SELECT * EXCLUDE (u1, u2), count(*) AS record_pairs FROM named_pairs GROUP BY ALL)"""

LINKS = """
links AS (
  SELECT record_uid, 'email' AS det_key, max(record_uid) OVER (PARTITION BY email) AS root_uid FROM valid WHERE email IS NOT NULL
  UNION ALL
  SELECT record_uid, 'phone+date_of_birth', max(record_uid) OVER (PARTITION BY phone, date_of_birth) FROM valid
  WHERE phone IS NOT NULL AND date_of_birth IS NOT NULL)"""

_EDGES = """
edges AS (SELECT l.record_uid AS a, r.record_uid AS b FROM valid l JOIN valid r ON l.record_uid != r.record_uid
          AND (l.email = r.email OR (l.phone = r.phone AND l.date_of_birth = r.date_of_birth)))"""


def closure(edges: str) -> str:
    """Largest uid reachable from every valid record over `edges` (a, b)."""
    return edges + """,
reach(record_uid, other) AS (SELECT record_uid, record_uid FROM valid
  UNION SELECT reach.record_uid, edges.b FROM reach JOIN edges ON edges.a = reach.other),
clusters AS (SELECT record_uid, concat('E-', substring(max(other), 1, 32)) AS cluster_id, max(other) AS root_uid
             FROM reach GROUP BY record_uid),
members AS (SELECT v.*, c.cluster_id FROM valid v JOIN clusters c USING (record_uid))"""


CLUSTERS = closure(_EDGES)

_RECENT = "try_cast(source_updated_at AS TIMESTAMP) DESC NULLS LAST"
_TRUST = "trust_rank ASC NULLS LAST"
_ORDER = {
    "full_name": ("source_precedence+most_recent", f"{_TRUST}, {_RECENT}"),
    **{a: ("most_recent+source_precedence", f"{_RECENT}, {_TRUST}") for a in ("email", "phone", "address_line", "city", "state")},
    "country": ("source_precedence", _TRUST),
    "date_of_birth": ("source_precedence+non_null_any", _TRUST),
}
GOLDEN = CLUSTERS + """,
decisions AS (""" + "\nUNION ALL ".join(
    f"""SELECT cluster_id, '{a}' AS attribute, {a} AS golden_value, record_uid AS winning_record_uid, source_id AS winning_source,
  '{name}' AS strategy FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY {order}, record_uid) AS rn
  FROM members WHERE {a} IS NOT NULL) WHERE rn = 1""" for a, (name, order) in _ORDER.items()) + """),
golden AS (SELECT cluster_id AS golden_id, """ + ", ".join(
    f"max(CASE WHEN attribute = '{a}' THEN golden_value END) AS {a}" for a in ATTRIBUTES) + f""",
  '{AS_OF} 00:00:00' AS mdm_created_ts, 'b1' AS batch_id FROM decisions GROUP BY cluster_id),
crosswalk AS (SELECT cluster_id AS golden_id, record_uid, source_id, source_record_id, batch_id FROM members)"""

_COUNTS = """,
tally AS (SELECT 'bronze' AS stage, source_id FROM bronze UNION ALL SELECT 'standardized', source_id FROM std
  UNION ALL SELECT CASE dq_status WHEN 'QUARANTINED' THEN 'quarantined' ELSE 'valid' END, source_id FROM checked
  UNION ALL SELECT 'linked', source_id FROM {linked}),
counts AS (SELECT coalesce(source_id, 'ALL') AS source_id, count(*) FILTER (stage = 'bronze') AS bronze,
  count(*) FILTER (stage = 'standardized') AS standardized, count(*) FILTER (stage = 'valid') AS valid,
  count(*) FILTER (stage = 'quarantined') AS quarantined, count(*) FILTER (stage = 'linked') AS linked
  FROM tally GROUP BY ROLLUP (source_id))"""


def _sql(select: str, *parts: str, as_of: str = AS_OF) -> str:
    return "WITH RECURSIVE " + ",".join([base(as_of), *parts]) + "\n" + select


def _extract(source: str) -> str:
    columns = ", ".join(f"{c} AS {n}" for n, c in zip(LAYOUT[source], CANONICAL))
    return f"WITH records AS ({RECORDS}) SELECT {columns} FROM records WHERE source_id = '{source}'"


def _log() -> str:
    return ", ".join(f"{{'attribute': '{a}', 'raw_value': raw_{a}, 'standardized_value': {a}, 'transforms_applied': '{c}'}}"
                     for a, c in CHAINS.items())


LOG = f"""
log AS (SELECT record_uid, source_id, source_updated_at, t.attribute AS attribute, t.raw_value AS raw_value,
  t.standardized_value AS standardized_value, t.transforms_applied AS transforms_applied
  FROM (SELECT *, unnest([{_log()}]) AS t FROM std))"""

_MARKS = """
marks AS (SELECT source_id, max(try_cast(source_updated_at AS TIMESTAMP)) AS high_water_mark FROM {rows}
          WHERE source_id IN ('CRM', 'WEB') GROUP BY source_id)"""

_SUBJECTS = """
subjects AS (SELECT DISTINCT golden_id FROM crosswalk JOIN customer ON source_record_id = concat('C', c_custkey)
             WHERE source_id = 'CRM' AND c_acctbal < 0)"""

MATCH_PAIRS = PAIRS + "," + LINKS + """,
match_pairs AS (SELECT DISTINCT record_uid AS record_uid_1, root_uid AS record_uid_2, 1::BIGINT AS record_pairs, 1.0::DOUBLE AS score,
    'deterministic' AS method, 'MATCH' AS decision FROM links WHERE record_uid != root_uid
  UNION ALL SELECT record_uid_1, record_uid_2, record_pairs, score, 'probabilistic', decision FROM fuzzy_pairs)"""


def _rates() -> str:
    return """
rates AS (SELECT 'errors' AS series, strftime(ts, '%Y-%m-%d') AS batch,
    round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 6) AS rate FROM events GROUP BY 2),
spikes AS (SELECT * FROM (SELECT *, avg(rate) OVER w AS baseline, stddev_samp(rate) OVER w AS deviation, count(*) OVER w AS n
    FROM rates WINDOW w AS (PARTITION BY series ORDER BY batch ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  WHERE n = 7 AND rate > baseline + 1.0 * deviation)"""


# Every pair of records on its own; only the names of the rows are the listed pair's.
_SLA = f"""
sla AS (SELECT record_uid_1, record_uid_2, score, count(*) AS late_pairs, max(waiting) AS days_waiting
  FROM (SELECT p.record_uid_1, p.record_uid_2, p.score,
          date_diff('day', greatest(try_cast(a.source_updated_at AS DATE), try_cast(z.source_updated_at AS DATE)), DATE '{AS_OF}') AS waiting
        FROM named_pairs p JOIN valid a ON a.record_uid = u1 JOIN valid z ON z.record_uid = u2 WHERE decision = 'REVIEW')
  WHERE waiting > 14 GROUP BY ALL)"""


def _rows(rules: list[tuple[str, str, str]], table: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{rule}' AS rule_id, '{severity}' AS severity FROM {table} WHERE NOT coalesce({check}, false)"
        for rule, severity, check in rules)


# ------------------------------------------------------------------ parts and documents

_PART_FORM = r"array_to_string(list_sort(list_filter(regexp_split_to_array(p_name, '\s+'), lambda t: length(t) > 0)), ' ')"
PARTS = f"""
valid AS (SELECT sha256(concat('PART||', p_partkey)) AS record_uid, {_title(_squeeze('p_name'))} AS p_name, p_brand,
            lower(p_type) AS p_type, CAST(p_size AS VARCHAR) AS p_size FROM part),
pairs AS (SELECT l.record_uid AS u1, r.record_uid AS u2, l.p_name AS n1, r.p_name AS n2, l.p_brand = r.p_brand AS b,
            l.p_type = r.p_type AS t, l.p_size = r.p_size AS s, l.p_name = r.p_name AS n
          FROM valid l JOIN valid r ON l.record_uid < r.record_uid
            AND (l.p_brand = r.p_brand OR (l.p_type = r.p_type AND l.p_size = r.p_size))),
forms AS (SELECT DISTINCT p_name, {_PART_FORM} AS form FROM valid),
texts AS (SELECT DISTINCT x.form AS a, y.form AS b FROM (SELECT DISTINCT n1, n2 FROM pairs)
          JOIN forms x ON x.p_name = n1 JOIN forms y ON y.p_name = n2)""" + _LCS + """,
scored AS (SELECT u1, u2, b AND t AND s AND n AS det, NOT t AS clash,
    round(0.5::DOUBLE * (2.0 * c.same_chars / (length(x.form) + length(y.form))) + 0.2::DOUBLE * b::INT + 0.2::DOUBLE * t::INT + 0.1::DOUBLE * s::INT, 4) AS fuzzy
  FROM pairs JOIN forms x ON x.p_name = n1 JOIN forms y ON y.p_name = n2 JOIN common c ON c.ta = x.form AND c.tb = y.form),
decided AS (SELECT *, CASE WHEN det THEN 'MATCH' WHEN clash THEN 'REJECTED_FP_GUARD' WHEN fuzzy >= 0.85 THEN 'MATCH'
  WHEN fuzzy >= 0.75 THEN 'REVIEW' ELSE 'NO_MATCH' END AS decision FROM scored)"""
_PART_CLOSURE = closure("""
edges AS (SELECT u1 AS a, u2 AS b FROM decided WHERE decision = 'MATCH' UNION ALL SELECT u2, u1 FROM decided WHERE decision = 'MATCH')""")

DOCUMENTS = r"""
valid AS (SELECT sha256(concat(source, '||', doc_id)) AS record_uid, source AS source_id, lang,
            CAST(regexp_replace(source, '[^0-9]', '', 'g') AS INT) AS trust_rank,
            trim(regexp_replace(lower(text), '\s+', ' ', 'g'), ' ') AS text FROM documents),
grouped AS (SELECT *, concat('E-', substring(max(record_uid) OVER w, 1, 32)) AS cluster_id, max(record_uid) OVER w AS root_uid,
              row_number() OVER (PARTITION BY text, lang ORDER BY trust_rank, record_uid) AS rn
            FROM valid WINDOW w AS (PARTITION BY text, lang))"""


# Found by record pairs: a member on either side of any pair of records, whichever pair is listed for it.
_MET = """
decisions_met AS (
  SELECT DISTINCT cluster_id AS golden_id, l.record_uid AS record_uid_1, l.root_uid AS record_uid_2, 1::BIGINT AS record_pairs,
    1.0::DOUBLE AS score, 'deterministic' AS method, 'MATCH' AS decision
  FROM links l JOIN clusters c ON c.record_uid IN (l.record_uid, l.root_uid) WHERE l.record_uid != l.root_uid
  UNION ALL
  SELECT DISTINCT c.cluster_id, p.record_uid_1, p.record_uid_2, f.record_pairs, p.score, 'probabilistic', p.decision
  FROM named_pairs p JOIN clusters c ON c.record_uid IN (p.u1, p.u2)
  JOIN fuzzy_pairs f ON f.record_uid_1 = p.record_uid_1 AND f.record_uid_2 = p.record_uid_2 AND f.score = p.score)"""

RULE_VERSION = "d6a63db3c347362e25a35a5935800207fe106192c25769442079afceb773ad02"  # hash of the published customer rules

_SECTIONS = {
    "source_records": ("record_uid source_id source_record_id raw_payload", "SELECT *, cluster_id AS golden_id FROM members"),
    "transforms": ("record_uid attribute raw_value standardized_value transforms_applied",
                   "SELECT log.*, cluster_id AS golden_id FROM log JOIN clusters USING (record_uid) WHERE raw_value IS DISTINCT FROM standardized_value"),
    "dq_annotations": ("record_uid rule_id severity description",
                       "SELECT results.*, cluster_id AS golden_id FROM results JOIN clusters USING (record_uid)"),
    "match_decisions": ("record_uid_1 record_uid_2 record_pairs score method decision", "SELECT * FROM decisions_met"),
    "survivorship_decisions": ("attribute golden_value winning_source strategy", "SELECT *, cluster_id AS golden_id FROM decisions"),
}
_TRACE = " UNION ALL ".join(
    f"SELECT golden_id, '{section}' AS section, CAST(json_object({', '.join(f"'{c}', {c}" for c in columns.split())}) AS VARCHAR)"
    f" AS evidence FROM ({rows})" for section, (columns, rows) in _SECTIONS.items())


# The last state of three batches: LEGACY without what its last extract lacks, every WEB and CRM record as it last came.
_LAST_STATE = f"""
SELECT source_id, trust_rank, source_record_id, full_name,
  CASE WHEN moved THEN concat('moved', k, '@example.com') ELSE email END AS email,
  CASE WHEN moved THEN CAST(6000000000 + k AS STRING) ELSE phone END AS phone, address_line, city, state, country, date_of_birth,
  CASE WHEN moved THEN '2026-07-20' WHEN source_id = 'WEB' AND k % 16 = 0 THEN '2026-07-25'
       WHEN source_id = 'CRM' AND k % 7 = 3 THEN '2026-07-01' ELSE source_updated_at END AS source_updated_at
FROM (SELECT *, source_id = 'WEB' AND k % 8 = 0 AND k % 16 != 0 AS moved
      FROM (SELECT *, CAST(regexp_extract(source_record_id, '([0-9]+)$', 1) AS BIGINT) AS k FROM ({RECORDS})))
WHERE NOT (source_id = 'LEGACY' AND k % 15 = 0)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "scan_csv": _extract("CRM"), "scan_ndjson": _extract("WEB"), "scan_delimited": _extract("LEGACY"),
        "dead_letter": """
            SELECT 'ORDERS' AS source_id, reason, payload, count(*) AS n_lines FROM (
              SELECT CASE WHEN o_orderstatus = 'P' THEN 'missing_key' ELSE 'corrupt_record' END AS reason,
                CASE WHEN o_orderstatus = 'P' THEN
                    concat('{"o_orderkey":null,"status":"P","total":"', o_orderpriority, '"}')
                  ELSE concat(o_orderkey, '|', o_orderstatus) END AS payload
              FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW') GROUP BY ALL""",
        "ingest_union": _sql(f"""SELECT record_uid, source_id, source_record_id, batch_id, ingest_ts, trust_rank, source_updated_at,
            {', '.join(ATTRIBUTES)} FROM bronze"""),
        "raw_payload": _sql("SELECT record_uid, source_id, raw_payload FROM bronze"),
        "rows_ingested": _sql("SELECT source_id, count(*) AS rows_ingested FROM bronze GROUP BY 1"),
        "high_water_marks": _sql("SELECT source_id, strftime(high_water_mark, '%Y-%m-%d %H:%M:%S') AS high_water_mark FROM marks",
                                 _MARKS.format(rows="bronze")),
        "ingest_incremental": _sql("""
            SELECT b.record_uid, b.source_id, b.source_record_id, b.source_updated_at FROM bronze b LEFT JOIN marks m USING (source_id)
            WHERE (m.high_water_mark IS NULL OR try_cast(b.source_updated_at AS TIMESTAMP) >= m.high_water_mark)
              AND NOT EXISTS (SELECT 1 FROM early e WHERE e.record_uid = b.record_uid AND e.raw_payload = b.raw_payload)""", """
            early AS (SELECT * FROM bronze WHERE source_updated_at < '2026-06-10' OR (source_id = 'WEB' AND city IN ('Delhi', 'Bombay')))""",
            _MARKS.format(rows="early")),
        "snapshot_diff": """SELECT concat('L', c_custkey) AS CUST_NO, CASE c_mktsegment WHEN 'BUILDING' THEN 'insert'
              WHEN 'MACHINERY' THEN 'delete' WHEN 'FURNITURE' THEN 'update' ELSE 'unchanged' END AS change
            FROM customer WHERE c_custkey % 3 = 0""",
        "contract_violations": f"""WITH records AS ({RECORDS})
            SELECT source_record_id AS user_id, 'C001' AS rule_id, 'ERROR' AS severity FROM records
            WHERE source_id = 'WEB' AND email IS NOT NULL AND email NOT LIKE '%@EXAMPLE.COM'
            UNION ALL SELECT source_record_id, 'C002', 'ERROR' FROM records WHERE source_id = 'WEB' AND phone IS NULL""",
        "layered_tables": f"""WITH records AS ({RECORDS})
            SELECT CASE source_id WHEN 'CRM' THEN '007' ELSE '010' END AS batch_id, source_id, count(*) AS n_rows
            FROM records WHERE source_id != 'WEB' GROUP BY ALL""",
        "audit_log": _sql("""SELECT 'bronze_ingest' AS stage, source_id, 'b1' AS batch_id, 'rows_ingested' AS metric, count(*) AS amount
            FROM bronze GROUP BY source_id
            UNION ALL SELECT 'dq_validation', 'ALL', 'b1', 'rows_in', count(*) FROM checked
            UNION ALL SELECT 'dq_validation', 'ALL', 'b1', 'rows_valid', count(*) FROM valid
            UNION ALL SELECT 'dq_validation', 'ALL', 'b1', 'rows_quarantined', count(*) FROM checked WHERE dq_status = 'QUARANTINED'"""),
        "rule_version": _sql(f"SELECT batch_id, '{RULE_VERSION}' AS rule_version, count(*) AS n_rows FROM std GROUP BY ALL"),
        "replay_as_of": _sql("""SELECT record_uid, source_id, batch_id, email FROM (
              SELECT record_uid, source_id, source_updated_at AS batch_id, email,
                row_number() OVER (PARTITION BY record_uid ORDER BY source_updated_at DESC) AS rn
              FROM bronze WHERE source_updated_at <= '2026-06-01') WHERE rn = 1"""),
        "transform_log": _sql("""SELECT record_uid, source_updated_at, attribute, raw_value, standardized_value, transforms_applied
            FROM log""", LOG),
        "changed_values": _sql("""SELECT source_id, attribute, transforms_applied, count(*) AS n_changed FROM log
            WHERE raw_value IS DISTINCT FROM standardized_value GROUP BY ALL""", LOG),
        "reference_lookup_join": """SELECT s_suppkey, s_name, coalesce(n_name, concat('n', s_nationkey)) AS s_nation
            FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey != 4) ON n_nationkey = s_nationkey""",
        "standardized_report": _sql("""SELECT source_id, source_record_id, source_updated_at, full_name, email, phone, city, state, country, date_of_birth
            FROM std ORDER BY source_id, source_record_id, source_updated_at LIMIT 30"""),
        "dq_results": _sql("SELECT record_uid, source_id, batch_id, rule_id, severity, description FROM results"),
        "dq_status": _sql("SELECT record_uid, source_updated_at, dq_status, len(dq_failures) AS n_failures FROM checked"),
        "dq_metrics": _sql("""SELECT source_id, count(*) AS rows_in, count(*) FILTER (dq_status != 'QUARANTINED') AS rows_valid,
            count(*) FILTER (dq_status = 'QUARANTINED') AS rows_quarantined, sum(len(dq_failures))::BIGINT AS rule_failures
            FROM checked GROUP BY 1"""),
        "valid_quarantine_split": _sql("""SELECT CASE dq_status WHEN 'QUARANTINED' THEN 'quarantine' ELSE 'valid' END AS side,
            record_uid, source_updated_at FROM checked"""),
        "quarantine_reasons": _sql("""SELECT DISTINCT source_id, source_record_id, rule_id, description FROM results
            WHERE severity = 'ERROR'"""),
        "dq_orders": _rows([
            ("O001", "WARN", "o_orderstatus IN ('O', 'F')"), ("O002", "ERROR", "o_totalprice > 1000"),
            ("O003", "ERROR", "copies = 1"),
            ("O004", "ERROR", "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"),
            ("O005", "WARN", "regexp_matches(o_orderpriority, '^[1-3]-')"),
            ("O006", "WARN", f"o_orderdate >= DATE '{AS_OF}' - INTERVAL 360 MONTH")],
            "(SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS copies FROM orders)", "o_orderkey"),
        "dq_lineitem": "SELECT l_returnflag, rule_id, count(*) AS failures FROM (" + _rows([
            ("L001", "ERROR", "copies = 1"),
            ("L002", "ERROR", "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus != 'P')"),
            ("L003", "WARN", "l_quantity BETWEEN 1 AND 45"), ("L004", "WARN", "l_returnflag IN ('A', 'N')")],
            "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem)",
            "l_returnflag") + ") GROUP BY ALL",
        "dq_conversations": """SELECT role, count(*) AS rows_in, count(*) FILTER (NOT bad) AS rows_valid,
              count(*) FILTER (bad) AS rows_quarantined, sum(n)::BIGINT AS rule_failures
            FROM (SELECT role, copies > 1 OR NOT coalesce(length(text) > 0, false) AS bad,
                (copies > 1)::INT + (NOT coalesce(role IN ('user', 'assistant'), false))::INT
                + (NOT coalesce(length(text) > 0, false))::INT AS n
              FROM (SELECT *, count(*) OVER (PARTITION BY conv_id, turn) AS copies FROM conversations)) GROUP BY 1""",
        "block_keys": _sql("SELECT * FROM blocks", BLOCKS),
        "block_sizes": _sql("""SELECT block_key, count(*) AS n_records, count(*) * (count(*) - 1) // 2 AS n_pairs
            FROM blocks GROUP BY 1""", BLOCKS),
        "oversize_blocks": _sql("""SELECT block_key, count(*) AS n_records, count(*) * (count(*) - 1) // 2 AS n_pairs
            FROM blocks GROUP BY 1 HAVING count(*) > 20""", BLOCKS),
        "candidate_pair_count": _sql("SELECT count(*) AS candidate_pairs FROM cand", _CANDIDATES),
        "deterministic_links": _sql("SELECT * FROM links WHERE record_uid != root_uid", LINKS),
        "pair_scores": _sql("""SELECT record_uid_1, record_uid_2, record_pairs, score, round(sim_full_name, 6) AS sim_full_name,
            round(sim_address_line, 6) AS sim_address_line, round(sim_email, 6) AS sim_email, round(sim_phone, 6) AS sim_phone,
            round(sim_date_of_birth, 6) AS sim_date_of_birth FROM fuzzy_pairs WHERE NOT same""", PAIRS),
        "match_pairs": _sql("SELECT * FROM match_pairs", MATCH_PAIRS),
        "match_bands": _sql("""SELECT d.decision, d.method, count(x.u1) AS record_pairs
            FROM (VALUES ('MATCH', 'deterministic'), ('MATCH', 'probabilistic'), ('REVIEW', 'probabilistic'),
                         ('REJECTED_FP_GUARD', 'probabilistic'), ('NO_MATCH', 'probabilistic')) d(decision, method)
            LEFT JOIN decided x ON x.decision = d.decision AND (CASE WHEN x.det THEN 'deterministic' ELSE 'probabilistic' END) = d.method
            GROUP BY ALL""", PAIRS),
        "review_queue": _sql("""SELECT record_uid_1, record_uid_2, record_pairs, score FROM fuzzy_pairs WHERE decision = 'REVIEW'
            ORDER BY score DESC, record_uid_1, record_uid_2 LIMIT 10""", PAIRS),
        "review_members": _sql("""SELECT DISTINCT record_uid_1, record_uid_2, score::DOUBLE AS score, unnest([u1, u2]) AS record_uid
            FROM named_pairs WHERE decision = 'REVIEW'""", PAIRS),
        "profile_members": _sql("SELECT record_uid, first_uid FROM prof", PAIRS),
        "clusters": _sql("SELECT * FROM clusters", CLUSTERS),
        "cluster_conflicts": _sql("""SELECT cluster_id, count(*) AS n_records, min(date_of_birth) != max(date_of_birth) AS date_of_birth_differs,
            min(country) != max(country) AS country_differs FROM members GROUP BY 1
            HAVING count(DISTINCT date_of_birth) > 1 OR count(DISTINCT country) > 1""", CLUSTERS).replace(RECORDS, f"""
            SELECT * REPLACE (CASE WHEN source_id = 'LEGACY' AND CAST(source_record_id[2:] AS BIGINT) % 24 = 0 THEN '19770707'
                                   ELSE date_of_birth END AS date_of_birth) FROM ({RECORDS})"""),
        "survivorship_decisions": _sql("SELECT * FROM decisions", GOLDEN),
        "golden": _sql("SELECT * FROM golden", GOLDEN),
        "crosswalk": _sql("SELECT * FROM crosswalk", GOLDEN),
        "golden_metrics": _sql("""SELECT count(DISTINCT golden_id) AS golden_records, count(*) AS source_records_linked
            FROM crosswalk""", GOLDEN),
        "golden_report": _sql("""SELECT golden_id, full_name, email, phone, city, state, date_of_birth FROM golden
            ORDER BY full_name, golden_id LIMIT 30""", GOLDEN),
        "enrichment": _sql("""SELECT c_custkey, c_mktsegment, x.golden_id, g.email AS golden_email, g.city AS golden_city
            FROM customer LEFT JOIN crosswalk x ON x.source_id = 'CRM' AND x.source_record_id = concat('C', c_custkey)
            LEFT JOIN golden g ON g.golden_id = x.golden_id""", GOLDEN),
        "reconcile_counts": _sql("SELECT * FROM counts", GOLDEN + _COUNTS.format(linked="crosswalk")),
        "reconcile_exceptions": _sql("""SELECT source_id, 'valid <> linked' AS transition, valid AS rows_before, linked AS rows_after
            FROM counts WHERE valid != linked
            UNION ALL SELECT source_id, 'bronze <> standardized', bronze, standardized FROM counts WHERE bronze != standardized
            UNION ALL SELECT source_id, 'standardized <> valid + quarantined', standardized, valid + quarantined FROM counts
              WHERE standardized != valid + quarantined""", GOLDEN, """
            kept AS (SELECT * FROM crosswalk WHERE source_record_id NOT IN (SELECT concat('C', c_custkey) FROM customer WHERE c_acctbal < 0))"""
            + _COUNTS.format(linked="kept")),
        "dedup_yield": _sql("""SELECT c.*, (SELECT count(*) FROM golden) AS golden_records,
            c.valid - (SELECT count(*) FROM golden) AS dedup_consolidation FROM counts c WHERE source_id = 'ALL'""",
            GOLDEN + _COUNTS.format(linked="crosswalk")),
        "lineage_members": _sql("SELECT golden_id, record_uid FROM crosswalk", GOLDEN),
        "lineage_sources": _sql("""SELECT cluster_id AS golden_id, record_uid, source_id, source_record_id, raw_payload FROM members""", CLUSTERS),
        "lineage_transforms": _sql("""SELECT cluster_id AS golden_id, record_uid, attribute, raw_value, standardized_value, transforms_applied
            FROM clusters JOIN log USING (record_uid) WHERE raw_value IS DISTINCT FROM standardized_value""", CLUSTERS, LOG),
        "lineage_dq": _sql("""SELECT cluster_id AS golden_id, record_uid, rule_id, severity, description
            FROM clusters JOIN results USING (record_uid)""", CLUSTERS, as_of="2027-08-01"),
        "lineage_matches": _sql("SELECT * FROM decisions_met", MATCH_PAIRS, CLUSTERS, _MET),
        "lineage_survivorship": _sql("""SELECT cluster_id AS golden_id, attribute, golden_value, winning_source, strategy
            FROM decisions""", GOLDEN),
        "lineage_trace": _sql(_TRACE, MATCH_PAIRS, GOLDEN, LOG, _MET),
        "lineage_documents": _sql(f"SELECT golden_id, section, 0::INT AS part, array_to_string(list_sort(list(evidence)), chr(10)) AS evidence"
                                  f" FROM ({_TRACE}) GROUP BY ALL", MATCH_PAIRS, GOLDEN, LOG, _MET),
        "sample_entities": _sql("""SELECT golden_id, count(*) AS n_members FROM crosswalk GROUP BY 1 HAVING count(*) >= 3
            ORDER BY 2 DESC, 1 LIMIT 5""", GOLDEN),
        "incremental_match": _sql("SELECT record_uid, cluster_id FROM clusters", CLUSTERS),
        "batch_entities": _sql("SELECT x.golden_id, x.record_uid, x.source_id, x.source_record_id, "
                               + ", ".join(f"g.{a} AS golden_{a}" for a in ATTRIBUTES)
                               + " FROM crosswalk x JOIN golden g ON g.golden_id = x.golden_id", GOLDEN).replace(RECORDS, _LAST_STATE),
        "incremental_redirects": _sql("""SELECT DISTINCT o.root AS old_root, c.root_uid FROM old_roots o
            JOIN clusters c ON c.record_uid = o.root WHERE c.root_uid != o.root""", CLUSTERS, """
            old_edges AS (SELECT edges.* FROM edges JOIN valid x ON x.record_uid = a JOIN valid y ON y.record_uid = b
                          WHERE x.source_id != 'WEB' AND y.source_id != 'WEB'),
            old_reach(record_uid, other) AS (SELECT record_uid, record_uid FROM valid WHERE source_id != 'WEB'
              UNION SELECT old_reach.record_uid, old_edges.b FROM old_reach JOIN old_edges ON old_edges.a = old_reach.other),
            old_roots AS (SELECT record_uid, max(other) AS root FROM old_reach GROUP BY 1)"""),
        "golden_upsert": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 0.0 ELSE c_acctbal END AS c_acctbal,
            c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 2 ELSE 1 END::INT AS version FROM customer""",
        "golden_versions": _sql("""SELECT * FROM (
              SELECT golden_id, full_name, city, 'b1' AS recorded_from, CASE WHEN f < '4' THEN 'b2' WHEN f = 'b' THEN 'b3' WHEN f = 'c' THEN 'b4' END AS recorded_to FROM g
              UNION ALL SELECT golden_id, full_name, 'Corrected', 'b2', CASE WHEN f < '2' THEN 'b3' END FROM g WHERE f < '4'
              UNION ALL SELECT golden_id, full_name, city, 'b3', NULL FROM g WHERE f < '2'
              UNION ALL SELECT golden_id, full_name, city, 'b4', NULL FROM g WHERE f = 'b')""",
            GOLDEN, " g AS (SELECT golden_id, full_name, city, golden_id[3] AS f FROM golden)"),
        "cdc_apply": """SELECT user_id, event_id, op, event_type, value FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'I'
              WHEN 'error' THEN 'D' ELSE 'U' END AS op, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events) WHERE rn = 1 AND op != 'D'""",
        "scd2_history": """SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
              strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS valid_to, lead(ts) OVER w IS NULL AS is_current
            FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS held FROM events)
            WHERE held IS DISTINCT FROM event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "metrics_quarantine_rate": _sql("""SELECT coalesce(source_id, 'ALL') AS source_id, count(*) AS rows_in,
            count(*) FILTER (dq_status = 'QUARANTINED') AS rows_quarantined,
            round(count(*) FILTER (dq_status = 'QUARANTINED') / count(*)::DOUBLE, 6) AS quarantine_rate
            FROM checked GROUP BY ROLLUP (source_id)"""),
        "metrics_failures": _sql("""SELECT coalesce(source_id, 'ALL') AS source_id, coalesce(rule_id, 'ALL') AS rule_id,
            count(*) AS failures FROM results GROUP BY CUBE (source_id, rule_id)"""),
        "metrics_review_depth": _sql("""SELECT score, count(*) AS queue_rows, sum(record_pairs)::BIGINT AS record_pairs
            FROM fuzzy_pairs WHERE decision = 'REVIEW' GROUP BY 1""", PAIRS),
        "metrics_batch_latency": """SELECT strftime(ts, '%Y-%m-%d') AS batch, count(*) AS n_events,
            (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds FROM events GROUP BY 1""",
        "alerts_rate_spike": "WITH " + _rates() + """ SELECT series, batch, rate, round(baseline, 6) AS baseline,
            round(deviation, 6) AS deviation FROM spikes""",
        "alerts_stalled_sources": _sql(f"""SELECT source_id, strftime(high_water_mark, '%Y-%m-%d %H:%M:%S') AS high_water_mark,
            date_diff('day', high_water_mark::DATE, DATE '{AS_OF}') AS days_behind FROM marks
            WHERE date_diff('day', high_water_mark::DATE, DATE '{AS_OF}') > 30""", _MARKS.format(rows="bronze")),
        "alerts_review_sla": _sql("SELECT * FROM sla", MATCH_PAIRS, _SLA),
        "alerts_summary": _sql(f"""SELECT 'reconciliation_exception' AS alert, 0::BIGINT AS occurrences
            UNION ALL SELECT 'rate_spike', count(*) FROM spikes
            UNION ALL SELECT 'watermark_stall', count(*) FROM marks WHERE date_diff('day', high_water_mark::DATE, DATE '{AS_OF}') > 30
            UNION ALL SELECT 'review_sla', count(*) FROM sla""",
            MATCH_PAIRS, _SLA, _rates(), _MARKS.format(rows="bronze")),
        "sar_export": _sql("""SELECT cluster_id AS golden_id, record_uid, source_id, source_record_id, raw_payload FROM members
            WHERE cluster_id IN (SELECT golden_id FROM subjects)""", GOLDEN, _SUBJECTS),
        "evidence_on_request": _sql("""SELECT u1 AS record_uid_1, u2 AS record_uid_2, score::DOUBLE AS score,
              CASE WHEN det THEN 'deterministic' ELSE 'probabilistic' END AS method, decision,
              concat_ws('+', CASE WHEN l.date_of_birth != r.date_of_birth THEN 'date_of_birth' END, CASE WHEN l.country != r.country THEN 'country' END) AS conflicts
            FROM decided JOIN valid l ON l.record_uid = u1 JOIN valid r ON r.record_uid = u2
            WHERE u1 IN (SELECT record_uid FROM crosswalk JOIN subjects USING (golden_id))
               OR u2 IN (SELECT record_uid FROM crosswalk JOIN subjects USING (golden_id))""", PAIRS, GOLDEN, _SUBJECTS),
        "erasure": _sql("""SELECT record_uid, source_id, source_record_id FROM members
            WHERE cluster_id NOT IN (SELECT golden_id FROM subjects)""", GOLDEN, _SUBJECTS),
        "erasure_layers": _sql("""SELECT 'customer_checked' AS name, record_uid AS held FROM checked WHERE record_uid NOT IN (FROM gone)
            UNION ALL SELECT 'crosswalk', record_uid FROM crosswalk WHERE record_uid NOT IN (FROM gone)
            UNION ALL SELECT 'golden_customer', golden_id FROM golden WHERE golden_id NOT IN (SELECT golden_id FROM subjects)
            UNION ALL SELECT 'dead_letters', 'C' || c_custkey || ';' || c_name FROM customer
            WHERE c_mktsegment = 'BUILDING' AND sha256('CRM||C' || c_custkey) NOT IN (FROM gone)""", GOLDEN, _SUBJECTS, """
            owned AS (SELECT record_uid FROM crosswalk JOIN subjects USING (golden_id)),
            gone AS (SELECT record_uid FROM owned UNION SELECT record_uid FROM checked WHERE dq_status = 'QUARANTINED'
              AND lower(trim(email)) IN (SELECT lower(trim(email)) FROM checked WHERE record_uid IN (FROM owned) AND email IS NOT NULL)
              AND record_uid NOT IN (SELECT record_uid FROM crosswalk))"""),
        "masking": _sql("""SELECT sha256(record_uid) AS record_uid, source_updated_at,
            regexp_replace(regexp_replace(regexp_replace(full_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS full_name,
            regexp_replace(email, '^[^@]+', '***') AS email, '******' || right(phone, 4) AS phone,
            CAST(NULL AS VARCHAR) AS address_line, substring(date_of_birth, 1, 4) AS date_of_birth, city FROM std"""),
        "pr_curve": _sql("""SELECT threshold, merged, true_merged, round(true_merged / merged::DOUBLE, 6) AS precision,
              round(CASE WHEN total = 0 THEN NULL ELSE true_merged / total::DOUBLE END, 6) AS recall
            FROM (SELECT threshold, sum(n) OVER w::BIGINT AS merged, sum(hits) OVER w::BIGINT AS true_merged,
                (SELECT count(*) FROM valid l JOIN valid r ON l.record_uid < r.record_uid AND l.source_record_id[2:] = r.source_record_id[2:]
                 WHERE regexp_matches(l.source_record_id, '^[CUL][0-9]+$') AND regexp_matches(r.source_record_id, '^[CUL][0-9]+$')
                   AND NOT coalesce(l.email = r.email, false)
                   AND NOT coalesce(l.phone = r.phone AND l.date_of_birth = r.date_of_birth, false)) AS total
              FROM (SELECT score AS threshold, sum(record_pairs) AS n, sum(CASE WHEN hit THEN record_pairs ELSE 0 END) AS hits
                FROM (SELECT f.*, regexp_matches(a.source_record_id, '^[CUL]') AND regexp_matches(z.source_record_id, '^[CUL]')
                        AND a.source_record_id[2:] = z.source_record_id[2:] AS hit
                  FROM fuzzy_pairs f JOIN valid a ON a.record_uid = record_uid_1 JOIN valid z ON z.record_uid = record_uid_2
                  WHERE NOT same) GROUP BY 1) WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
            UNION ALL SELECT 0.0, merged, true_merged, round(true_merged / merged::DOUBLE, 6), round(CASE WHEN total > 0 THEN true_merged / total::DOUBLE END, 6)
            FROM (SELECT count(*) AS merged, count(*) FILTER (regexp_matches(l.source_record_id, '^[CUL]') AND regexp_matches(r.source_record_id, '^[CUL]')
                      AND l.source_record_id[2:] = r.source_record_id[2:]) AS true_merged,
                    (SELECT count(*) FROM valid x JOIN valid y ON x.record_uid < y.record_uid AND x.source_record_id[2:] = y.source_record_id[2:]
                     WHERE regexp_matches(x.source_record_id, '^[CUL][0-9]+$') AND regexp_matches(y.source_record_id, '^[CUL][0-9]+$')
                       AND NOT coalesce(x.email = y.email, false) AND NOT coalesce(x.phone = y.phone AND x.date_of_birth = y.date_of_birth, false)) AS total
                  FROM decided JOIN valid l ON l.record_uid = u1 JOIN valid r ON r.record_uid = u2 WHERE NOT det) WHERE merged > 0""",
            PAIRS.replace("fuzzy >= 0.65)", "fuzzy >= 0.45)")),
        "label_threshold_curve": r"""SELECT threshold, merged, true_merged, round(true_merged / merged::DOUBLE, 6) AS precision,
              round(true_merged / total::DOUBLE, 6) AS recall
            FROM (SELECT threshold, sum(n) OVER w::BIGINT AS merged, sum(hits) OVER w::BIGINT AS true_merged, sum(hits) OVER () AS total
              FROM (SELECT round(length(regexp_replace(text, '[^\p{L}]', '', 'g')) / greatest(length(text), 1)::DOUBLE, 2) AS threshold,
                  count(*) AS n, count(*) FILTER (quality = 1) AS hits FROM documents JOIN labels USING (doc_id) GROUP BY 1)
              WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))""",
        "part_match_bands": "WITH RECURSIVE " + PARTS + """
            SELECT d.decision, d.method, count(x.u1) AS record_pairs
            FROM (VALUES ('MATCH', 'deterministic'), ('MATCH', 'probabilistic'), ('REVIEW', 'probabilistic'),
                         ('REJECTED_FP_GUARD', 'probabilistic'), ('NO_MATCH', 'probabilistic')) d(decision, method)
            LEFT JOIN decided x ON x.decision = d.decision AND (CASE WHEN x.det THEN 'deterministic' ELSE 'probabilistic' END) = d.method
            GROUP BY ALL""",
        "part_match_pairs": "WITH RECURSIVE " + PARTS + """,
            prof AS (SELECT record_uid, min(record_uid) OVER (PARTITION BY p_name, p_brand, p_type, p_size) AS first_uid,
                       max(record_uid) OVER (PARTITION BY p_name, p_brand, p_type, p_size) AS last_uid FROM valid)
            SELECT record_uid AS record_uid_1, last_uid AS record_uid_2, 1::BIGINT AS record_pairs, 1.0::DOUBLE AS score,
              'deterministic' AS method, 'MATCH' AS decision FROM prof WHERE record_uid != last_uid
            UNION ALL SELECT least(a.first_uid, z.first_uid), greatest(a.first_uid, z.first_uid), count(*), fuzzy, 'probabilistic', decision
            FROM decided JOIN prof a ON a.record_uid = u1 JOIN prof z ON z.record_uid = u2 WHERE NOT det AND fuzzy >= 0.75 GROUP BY ALL""",
        "part_clusters": "WITH RECURSIVE " + PARTS + "," + _PART_CLOSURE + " SELECT * FROM clusters",
        "part_golden": "WITH RECURSIVE " + PARTS + "," + _PART_CLOSURE + """
            SELECT cluster_id AS golden_id, arg_min(p_name, (-length(p_name), record_uid)) AS p_name, arg_min(p_brand, record_uid) AS p_brand,
              arg_min(p_type, record_uid) AS p_type, arg_min(p_size, record_uid) AS p_size, 'b1' AS batch_id FROM members GROUP BY 1""",
        "document_clusters": "WITH " + DOCUMENTS + " SELECT record_uid, cluster_id, root_uid FROM grouped",
        "document_survivors": "WITH " + DOCUMENTS + """ SELECT cluster_id, record_uid AS winning_record_uid, source_id AS winning_source,
            sha256(text) AS text_sha FROM grouped WHERE rn = 1""",
        "stream_ingest": _sql(f"""SELECT record_uid, source_id, source_record_id, 'stream' AS batch_id, trust_rank, source_updated_at,
            {', '.join(ATTRIBUTES)} FROM bronze WHERE source_id = 'WEB'"""),
        "stream_quality": _sql("SELECT source_id, dq_status, count(*) AS n_rows FROM checked GROUP BY ALL"),
        "stream_unique": _sql("""SELECT record_uid, source_id, count(*) OVER (PARTITION BY epoch, email) > 1
              OR min(epoch) OVER (PARTITION BY email) < epoch AS email_repeated
            FROM (SELECT *, CASE source_id WHEN 'CRM' THEN 1 WHEN 'LEGACY' THEN 2 ELSE 3 END AS epoch FROM std)"""),
        "stream_match": _sql("SELECT record_uid, cluster_id FROM clusters", CLUSTERS),
        "stream_dedup": "SELECT event_id, user_id, event_type, value FROM events",
    }
    for a in ATTRIBUTES:
        q[f"std_{a}"] = _sql(f"SELECT source_id, source_record_id, {a}, count(*) AS n_rows FROM std GROUP BY ALL")
    return q
