"""Smeltery: bronze, silver and gold tables, quality flags and a run ledger as Spark DataFrame jobs."""

from smeltery.config import CleaningConfig, OutlierRule
from smeltery.session import build_session, ensure_utc, stage

__all__ = ["CleaningConfig", "OutlierRule", "build_session", "ensure_utc", "stage"]
