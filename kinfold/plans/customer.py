"""The customer entity: its control plane as plain data.

Fixed values.  Source layouts, vocabularies, patterns, formats, weights,
thresholds and strategies below are configuration that results depend on.
"""

from kinfold.spec import EntitySpec

AS_OF = "2026-08-01"

ATTRIBUTES = ["full_name", "email", "phone", "address_line", "city", "state", "country", "date_of_birth"]

SOURCES = [
    {
        "source_id": "CRM", "format": "csv", "path": "landing/crm/*.csv",
        "load_type": "incremental", "schema_evolution": "merge", "trust_rank": 1,
        "field_map": {
            "cust_id": "source_record_id", "full_name": "full_name", "email_addr": "email", "phone": "phone",
            "addr_line": "address_line", "city": "city", "state": "state", "country": "country",
            "dob": "date_of_birth", "updated_at": "source_updated_at",
        },
    },
    {
        "source_id": "WEB", "format": "json", "path": "landing/web/*.json",
        "load_type": "incremental", "schema_evolution": "merge", "trust_rank": 2,
        "field_map": {
            "user_id": "source_record_id", "name": "full_name", "contact_email": "email", "mobile": "phone",
            "street": "address_line", "city_name": "city", "region": "state", "country_code": "country",
            "birth_date": "date_of_birth", "modified_ts": "source_updated_at",
        },
    },
    {
        "source_id": "LEGACY", "format": "csv", "path": "landing/legacy/*.dat", "options": {"sep": "|"},
        "load_type": "full", "schema_evolution": "strict", "trust_rank": 3,
        "field_map": {
            "CUST_NO": "source_record_id", "CUST_NAME": "full_name", "EMAIL": "email", "TEL": "phone",
            "ADDR": "address_line", "CITY": "city", "ST": "state", "CTRY": "country",
            "BIRTH_DT": "date_of_birth", "LAST_UPD": "source_updated_at",
        },
    },
]

STANDARDIZATION = {
    "full_name": [{"transform": "trim"}, {"transform": "collapse_whitespace"}, {"transform": "title_case"},
                  {"transform": "strip_titles"}],
    "email": [{"transform": "trim"}, {"transform": "lower_case"}, {"transform": "null_if_invalid_email"}],
    "phone": [{"transform": "digits_only"},
              {"transform": "normalize_phone", "params": {"country_code": "91", "trunk_prefix": "0"}}],
    "address_line": [
        {"transform": "trim"}, {"transform": "collapse_whitespace"}, {"transform": "title_case"},
        {"transform": "expand_abbreviations", "params": {"map": {
            "St": "Street", "Rd": "Road", "Apt": "Apartment", "Blk": "Block", "Sec": "Sector"}}}],
    "city": [
        {"transform": "trim"}, {"transform": "title_case"},
        {"transform": "reference_lookup", "params": {"map": {
            "Gurgaon": "Gurugram", "Bombay": "Mumbai", "Bangalore": "Bengaluru", "Calcutta": "Kolkata"}}}],
    "state": [
        {"transform": "trim"}, {"transform": "upper_case"},
        {"transform": "reference_lookup", "params": {"map": {
            "HARYANA": "HR", "DELHI": "DL", "MAHARASHTRA": "MH", "KARNATAKA": "KA", "UTTAR PRADESH": "UP",
            "WEST BENGAL": "WB"}}}],
    "country": [
        {"transform": "trim"}, {"transform": "upper_case"},
        {"transform": "reference_lookup", "params": {"map": {"INDIA": "IN", "IND": "IN", "BHARAT": "IN"}}}],
    "date_of_birth": [
        {"transform": "parse_date", "params": {"formats": [
            "yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "MM/dd/yyyy", "yyyyMMdd", "dd-MMM-yyyy"]}}],
}

RULES = [
    {"rule_id": "DQ001", "rule_type": "not_null", "column": "full_name", "severity": "ERROR",
     "description": "Full name is mandatory"},
    {"rule_id": "DQ002", "rule_type": "expression", "severity": "ERROR",
     "expression": "email IS NOT NULL OR phone IS NOT NULL",
     "description": "At least one contact identifier (email or phone) must exist"},
    {"rule_id": "DQ003", "rule_type": "regex", "column": "email", "allow_null": True, "severity": "ERROR",
     "pattern": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
     "description": "Email must be well-formed"},
    {"rule_id": "DQ004", "rule_type": "regex", "column": "phone", "allow_null": True, "severity": "WARN",
     "pattern": "^[6-9][0-9]{9}$",
     "description": "Phone must be a 10-digit national number"},
    {"rule_id": "DQ005", "rule_type": "domain", "column": "country", "allow_null": True, "severity": "WARN",
     "allowed_values": ["IN", "US", "GB", "AE", "SG"],
     "description": "Country must be in the ISO reference list (domain validation)"},
    {"rule_id": "DQ006", "rule_type": "expression", "severity": "ERROR",
     "expression": "date_of_birth IS NULL OR (try_cast(date_of_birth AS DATE) > DATE'1900-01-01'"
                   " AND try_cast(date_of_birth AS DATE) < {as_of})",
     "description": "Date of birth must be a valid past date (business rule)"},
    {"rule_id": "DQ007", "rule_type": "unique", "columns": ["batch_id", "source_id", "source_record_id"],
     "severity": "ERROR",
     "description": "source_record_id must be unique within a source batch (duplicate key)"},
    {"rule_id": "DQ008", "rule_type": "expression", "severity": "WARN",
     "expression": "source_updated_at IS NULL OR try_cast(source_updated_at AS DATE) >= add_months({as_of}, -36)",
     "description": "Record freshness — source timestamp within last 3 years (timeliness)"},
]

MATCHING = {
    "blocking": [
        # A name without any letter a-z has no name block (NULL key).
        {"name": "name", "columns": ["full_name"],
         "expr": "concat('N|', substring(nullif(regexp_replace(lower(full_name), '[^a-z]', ''), ''), 1, 3))"},
        {"name": "phone", "columns": ["phone"], "expr": "concat('P|', right(phone, 4))"},
        {"name": "email", "columns": ["email"], "expr": "concat('E|', left(email, 4))"},
    ],
    "deterministic": [["email"], ["phone", "date_of_birth"]],
    "features": [
        {"attribute": "full_name", "method": "token_sort_ratio", "weight": 0.40},
        {"attribute": "address_line", "method": "token_set_ratio", "weight": 0.25},
        {"attribute": "email", "method": "exact", "weight": 0.15},
        {"attribute": "phone", "method": "exact", "weight": 0.10},
        {"attribute": "date_of_birth", "method": "exact", "weight": 0.10},
    ],
    "thresholds": {"auto_match": 0.85, "review": 0.65},
    "conflict_columns": ["date_of_birth", "country"],
}

SURVIVORSHIP = {
    "full_name": ["source_precedence", "most_recent"],
    "email": ["most_recent", "source_precedence"],
    "phone": ["most_recent", "source_precedence"],
    "address_line": ["most_recent", "source_precedence"],
    "city": ["most_recent", "source_precedence"],
    "state": ["most_recent", "source_precedence"],
    "country": ["source_precedence"],
    "date_of_birth": ["source_precedence", "non_null_any"],
}

RAW_SPEC = {
    "entity": "customer", "attributes": ATTRIBUTES, "sources": SOURCES, "standardization": STANDARDIZATION,
    "rules": RULES, "matching": MATCHING, "survivorship": SURVIVORSHIP, "default_strategy": ["non_null_any"],
}

CUSTOMER = EntitySpec.parse(RAW_SPEC)
