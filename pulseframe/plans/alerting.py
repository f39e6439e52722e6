"""Alerts from stored fingerprints: read documents, build alerts, merge the history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from pulseframe.operators.alerts import all_alerts, behavior_alerts, health_alerts
from pulseframe.rules import AlertRules
from pulseframe.sources.alert_store import update_history


def build_alerts(
    weekly: DataFrame, monthly: DataFrame, generated: str | None = None, limits: AlertRules = AlertRules(), *,
    batch: str = "month",
) -> DataFrame:
    """Alerts of weekly fingerprints and of monthly health rows, in alert order."""
    return all_alerts(behavior_alerts(weekly, generated, limits), health_alerts(monthly, generated, batch))


def refresh_alerts(
    weekly: DataFrame, monthly: DataFrame, history_path: str, limits: AlertRules = AlertRules(),
    generated: datetime | None = None,
) -> DataFrame:
    moment = (generated or datetime.now(timezone.utc)).isoformat()
    return update_history(build_alerts(weekly, monthly, moment, limits), history_path, limits)
