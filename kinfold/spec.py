"""Entity specifications: the control plane as validated, plain data.

A spec is a mapping (usually one YAML document per entity).  Every key is
either used by an operator or rejected here, so that a configured rule can
never be silently without effect.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet", "orc")
LOAD_TYPES = ("full", "incremental")
EVOLUTIONS = ("merge", "strict")
SEVERITIES = ("ERROR", "WARN")
METHODS = ("exact", "token_sort_ratio", "token_set_ratio")
STRATEGIES = ("source_precedence", "most_recent", "non_null_longest", "non_null_any")

KEY = "source_record_id"
UPDATED = "source_updated_at"


class SpecError(ValueError):
    """A specification that no operator could honour."""


def _only(where: str, given: Mapping, allowed: set[str], required: set[str] = frozenset()) -> None:
    unknown, missing = set(given) - allowed, required - set(given)
    if unknown:
        raise SpecError(f"{where}: unknown keys {sorted(unknown)}")
    if missing:
        raise SpecError(f"{where}: missing keys {sorted(missing)}")


def _one_of(where: str, value, choices) -> None:
    if value not in choices:
        raise SpecError(f"{where}: {value!r} is not one of {list(choices)}")


@dataclass(frozen=True)
class Source:
    source_id: str
    format: str
    path: str
    field_map: dict[str, str]
    options: dict[str, str] = field(default_factory=dict)
    load_type: str = "full"
    schema_evolution: str = "merge"
    trust_rank: int = 99
    contract: list[dict] = field(default_factory=list)

    @classmethod
    def parse(cls, raw: Mapping) -> "Source":
        where = f"source {raw.get('source_id', '?')}"
        _only(where, raw, set(cls.__dataclass_fields__) | {"description"},
              {"source_id", "format", "path", "field_map"})
        source = cls(**{k: v for k, v in raw.items() if k != "description"})
        if source.format not in FORMATS:
            raise SpecError(f"Unsupported format: {source.format}")
        _one_of(where, source.load_type, LOAD_TYPES)
        _one_of(where, source.schema_evolution, EVOLUTIONS)
        if KEY not in source.field_map.values():
            raise SpecError(f"{where}: no column is mapped to {KEY}")
        return source

    @property
    def schema(self) -> T.StructType:
        """Extract columns as they arrive: all strings, in the order of the field map."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.field_map])


@dataclass(frozen=True)
class BlockKey:
    """`expr` is a SQL key; equality on all `columns` implies equality of the key."""

    name: str
    expr: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Feature:
    attribute: str
    method: str
    weight: float


@dataclass(frozen=True)
class Matching:
    blocking: tuple[BlockKey, ...]
    deterministic: tuple[tuple[str, ...], ...]
    features: tuple[Feature, ...]
    auto_match: float
    review: float
    conflict_columns: tuple[str, ...] = ()

    @classmethod
    def parse(cls, raw: Mapping) -> "Matching":
        _only("matching", raw, {"blocking", "deterministic", "features", "thresholds", "conflict_columns"},
              {"blocking", "deterministic", "features", "thresholds"})
        _only("thresholds", raw["thresholds"], {"auto_match", "review"}, {"auto_match", "review"})
        for f in raw["features"]:
            _only("feature", f, {"attribute", "method", "weight"}, {"attribute", "method", "weight"})
            _one_of("feature method", f["method"], METHODS)
        for b in raw["blocking"]:
            _only("block key", b, {"name", "expr", "columns"}, {"name", "expr", "columns"})
        return cls(
            blocking=tuple(BlockKey(b["name"], b["expr"], tuple(b["columns"])) for b in raw["blocking"]),
            deterministic=tuple(tuple(k) for k in raw["deterministic"]),
            features=tuple(Feature(f["attribute"], f["method"], float(f["weight"])) for f in raw["features"]),
            auto_match=float(raw["thresholds"]["auto_match"]),
            review=float(raw["thresholds"]["review"]),
            conflict_columns=tuple(raw.get("conflict_columns", ())),
        )

    @property
    def columns(self) -> list[str]:
        """Every column on which a pair decision can depend."""
        cols: list[str] = []
        for group in (*(b.columns for b in self.blocking), *self.deterministic,
                      [f.attribute for f in self.features], self.conflict_columns):
            cols += [c for c in group if c not in cols]
        return cols


@dataclass(frozen=True)
class EntitySpec:
    entity: str
    attributes: tuple[str, ...]
    sources: tuple[Source, ...] = ()
    standardization: dict[str, list[dict]] = field(default_factory=dict)
    rules: tuple[dict, ...] = ()
    matching: Matching | None = None
    survivorship: dict[str, list[str]] = field(default_factory=dict)
    default_strategy: tuple[str, ...] = ("non_null_any",)
    version: str = ""

    @classmethod
    def parse(cls, raw: Mapping) -> "EntitySpec":
        from kinfold.functions.checks import RULE_KEYS
        from kinfold.functions.transforms import TRANSFORMS

        _only("entity spec", raw, {"entity", "attributes", "sources", "standardization", "rules", "matching",
                                   "survivorship", "default_strategy"}, {"entity", "attributes"})
        attributes = tuple(raw["attributes"])
        known = {*attributes, KEY, UPDATED}
        sources = tuple(Source.parse(s) for s in raw.get("sources", ()))
        for s in sources:
            stray = set(s.field_map.values()) - known
            if stray:
                raise SpecError(f"source {s.source_id}: not canonical {sorted(stray)}")
        for attr, chain in raw.get("standardization", {}).items():
            for step in chain:
                _only(f"standardization of {attr}", step, {"transform", "params"}, {"transform"})
                _one_of(f"transform of {attr}", step["transform"], TRANSFORMS)
        for rule in raw.get("rules", ()):
            _one_of("rule_type", rule.get("rule_type"), RULE_KEYS)
            need, may = RULE_KEYS[rule["rule_type"]]
            base = {"rule_id", "rule_type", "severity", "description"}
            _only(f"rule {rule.get('rule_id', '?')}", rule, base | need | may, base | need)
            _one_of(f"severity of {rule['rule_id']}", rule["severity"], SEVERITIES)
        for attr, strategies in raw.get("survivorship", {}).items():
            for s in strategies:
                _one_of(f"strategy of {attr}", s, STRATEGIES)
        digest = hashlib.sha256(json.dumps(raw, sort_keys=True, default=str).encode()).hexdigest()
        return cls(
            entity=raw["entity"], attributes=attributes, sources=sources,
            standardization=dict(raw.get("standardization", {})), rules=tuple(raw.get("rules", ())),
            matching=Matching.parse(raw["matching"]) if "matching" in raw else None,
            survivorship=dict(raw.get("survivorship", {})),
            default_strategy=tuple(raw.get("default_strategy", ("non_null_any",))), version=digest,
        )

    def source(self, source_id: str) -> Source:
        return next(s for s in self.sources if s.source_id == source_id)


def load_spec(path: str | Path) -> EntitySpec:
    """Read one entity spec from a YAML (or JSON) document."""
    import yaml

    return EntitySpec.parse(yaml.safe_load(Path(path).read_text()))
