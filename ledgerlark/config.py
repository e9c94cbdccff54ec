"""Frozen parameter objects (the reference's ``var(name, default)`` knobs)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class AnomalyParams:
    """K02 robust-z detector parameters."""

    z_threshold: float = 3.5
    baseline_days: int = 14
    baseline_weeks: int = 4
    min_history_days: int = 7
    min_history_weeks: int = 3


@dataclass(frozen=True)
class WarehouseConfig:
    anomaly: AnomalyParams = field(default_factory=AnomalyParams)
    incident_date: str = "2024-02-11"
    cost_mismatch_slo: float = 0.02
    freshness_warn_hours: int = 24
    freshness_error_hours: int = 72
