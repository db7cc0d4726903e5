"""Cleaning configuration: plain values that the column builders read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class OutlierRule:
    """Inclusive numeric bounds; a missing bound is open."""

    min_value: float | None = None
    max_value: float | None = None


@dataclass(frozen=True)
class CleaningConfig:
    """``allowed_keys`` empty or None keeps every column; mapping keys are lower case."""

    allowed_keys: frozenset[str] | set[str] | None = None
    day_first: bool = True
    category_mapping: Mapping[str, str] = field(default_factory=dict)
    outlier_rules: Mapping[str, OutlierRule] = field(default_factory=dict)


# The configuration of the silver refresh.
SILVER_CONFIG = CleaningConfig(
    allowed_keys=frozenset({"source_id", "event_time", "value", "category"})
)
