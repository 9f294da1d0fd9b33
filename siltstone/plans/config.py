"""Run configuration: names, sources, rules and gold tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# How the example's change feed reads, and its one rule that stops a run.
CDC = {"keys": ["id"], "sequence_by": "seq", "deletes": "op = 'DELETE'", "except_cols": ["op", "seq"]}
ORDER_RULES = {"amount_non_negative": "amount >= 0"}


@dataclass(frozen=True)
class Config:
    source: str
    bronze_table: str
    silver_table: str
    gold_tables: list[dict[str, str]]
    expectations: dict[str, str] = field(default_factory=dict)
    measures: dict[str, str] = field(default_factory=dict)
    landing_table: str | None = None
    cdc_source: str | None = None
    orders_source: str | None = None
    cdc: dict[str, Any] = field(default_factory=lambda: dict(CDC))
    order_rules: dict[str, str] = field(default_factory=lambda: dict(ORDER_RULES))
    minimum_column: str = "fare_amount"

    @property
    def dimensions(self) -> dict[str, str]:
        return {spec["name"]: spec["dimension"] for spec in self.gold_tables}


def load_config(source: str | Path | Mapping[str, Any]) -> Config:
    """From a mapping, a JSON file or a YAML file.

    Rules may be missing; gold tables may not.  Unknown entries are refused, as
    a misspelt rule block would otherwise check nothing.
    """
    values = dict(source) if isinstance(source, Mapping) else _parse(Path(source))
    missing = {"source", "bronze_table", "silver_table", "gold_tables"} - values.keys()
    unknown = values.keys() - Config.__dataclass_fields__.keys()
    if missing or unknown:
        raise ValueError(f"config: missing {sorted(missing)}, unknown {sorted(unknown)}")
    for block in ("expectations", "measures"):
        values[block] = values.get(block) or {}
    return Config(**values)


def _parse(path: Path) -> dict[str, Any]:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as fault:
        raise RuntimeError("YAML configs need the yaml module; JSON works without") from fault
    return yaml.safe_load(text)
