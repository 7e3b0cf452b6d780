"""Run settings from a file with the sections ``pipeline``, ``jdbc`` and ``tables``."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import timedelta

from parcel_engine.functions.delivery import LATE_REASONS, SLA_HOURS
from parcel_engine.plans.daily import Tables
from parcel_engine.sources.jdbc import FETCH_SIZE, NUM_PARTITIONS
from parcel_engine.watermark import LOOKBACK


@dataclass(frozen=True)
class Settings:
    sla_hours: float = SLA_HOURS
    late_reasons: dict[str, list[str]] = field(default_factory=lambda: dict(LATE_REASONS))
    lookback: timedelta = LOOKBACK
    overlap: timedelta = LOOKBACK
    source_table: str = "delivery_events"
    fetch_size: int = FETCH_SIZE
    num_partitions: int = NUM_PARTITIONS
    tables: Tables = field(default_factory=Tables)


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text) or {}


def load_settings(path: str | None) -> Settings:
    """Settings from a YAML file (JSON where PyYAML is absent); defaults fill the gaps."""
    config = _read(path) if path else {}
    pipeline, jdbc = config.get("pipeline", {}), config.get("jdbc", {})
    lookback = timedelta(days=pipeline.get("lookback_days", LOOKBACK.days))
    overlap = pipeline.get("overlap_days")
    return Settings(
        sla_hours=float(pipeline.get("sla_hours", SLA_HOURS)),
        late_reasons=pipeline.get("late_reasons", dict(LATE_REASONS)),
        lookback=lookback,
        overlap=lookback if overlap is None else timedelta(days=overlap),
        source_table=jdbc.get("source_table", "delivery_events"),
        fetch_size=int(jdbc.get("fetch_size", FETCH_SIZE)),
        num_partitions=int(jdbc.get("num_partitions", NUM_PARTITIONS)),
        tables=Tables(**config.get("tables", {})),
    )
