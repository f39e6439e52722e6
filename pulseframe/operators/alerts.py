"""Alerts from weekly and monthly results, their history, and the status derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import rules
from pulseframe.functions import sprintf
from pulseframe.rules import AlertRules

ALERT_FIELDS = {
    "alert_id": "string",
    "alert_type": "string",
    "batch": "string",
    "batch_timestamp": "string",
    "severity": "string",
    "similarity_score": "double",
    "drift_status": "string",
    "trigger": "string",
    "top_deviating_features":
        "array<struct<feature:string,z_score:double,current:double,baseline_mean:double>>",
    "anomalies": "array<string>",
    "source_window_note": "string",
    "generated_timestamp": "string",
}
ALERT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ALERT_FIELDS.items())


def alert_id(alert_type: str, batch: Column) -> Column:
    return F.concat(F.lit(rules.ALERT_ID_PREFIX[alert_type]), batch)


def _shaped(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Select the alert fields in order, typed; fields without a value are NULL."""
    return df.select(*[
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in ALERT_FIELDS.items()
    ])


def behavior_alerts(
    fingerprints: DataFrame, generated: str | None = None, limits: AlertRules = AlertRules()
) -> DataFrame:
    """One alert per week whose drift is statistically established (``weekly_fingerprints`` rows)."""
    score, status = F.col("behavioral_similarity_score"), F.col("drift_status")
    calm = [rules.NORMAL, rules.BASELINE_BUILDING, rules.INSUFFICIENT_HISTORY]
    names = F.array_join(
        F.transform("top_deviating_features", lambda f: F.replace(f["feature"], F.lit("_"), F.lit(" "))), ", "
    )
    suffix = F.when(
        F.col("is_partial_source_window"), sprintf(rules.PARTIAL_WEEK_SUFFIX, F.col("source_window_note"))
    ).otherwise("")
    trigger = F.concat(
        sprintf(
            rules.BEHAVIOR_TRIGGER, status, score.cast("string"),
            F.when(names != "", names).otherwise(rules.NO_TOP_FEATURES),
        ),
        suffix,
    )
    severity = (
        F.when(score < limits.critical_below, "CRITICAL")
        .when(status == rules.MAJOR_DRIFT, "HIGH")
        .otherwise("WARNING")
    )
    return _shaped(fingerprints.filter(F.col("baseline_ready") & ~status.isin(calm)), {
        "alert_id": alert_id(rules.BEHAVIORAL_DRIFT, F.col("week")),
        "alert_type": F.lit(rules.BEHAVIORAL_DRIFT),
        "batch": F.col("week"),
        "batch_timestamp": F.col("week"),
        "severity": severity,
        "similarity_score": score,
        "drift_status": status,
        "trigger": trigger,
        "top_deviating_features": F.col("top_deviating_features"),
        "source_window_note": F.col("source_window_note"),
        "generated_timestamp": F.lit(generated),
    })


def health_alerts(health: DataFrame, generated: str | None = None, batch: str = "batch") -> DataFrame:
    """One CRITICAL alert per batch with critical health (``batch_health`` rows)."""
    trigger = sprintf(
        rules.HEALTH_TRIGGER, F.col("health_score"), F.array_join("data_quality_anomalies", "; ")
    )
    return _shaped(health.filter(F.col("health_status") == "Critical"), {
        "alert_id": alert_id(rules.DATA_HEALTH, F.col(batch)),
        "alert_type": F.lit(rules.DATA_HEALTH),
        "batch": F.col(batch),
        "batch_timestamp": F.col(batch),
        "severity": F.lit("CRITICAL"),
        "trigger": trigger,
        "anomalies": F.col("data_quality_anomalies"),
        "generated_timestamp": F.lit(generated),
    })


def in_alert_order(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("batch_timestamp", "alert_id")


def all_alerts(behavior: DataFrame, health: DataFrame) -> DataFrame:
    return in_alert_order(behavior.unionByName(health))


def active_history(history: DataFrame, limits: AlertRules = AlertRules()) -> DataFrame:
    return history.filter(F.col("batch").startswith(limits.active_year))


def merge_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """One alert per (type, batch): a new one replaces an old one whatever its id, unmatched old ones stay.

    Running the merge again with the same alerts changes nothing. The newest entry is picked by a combinable
    aggregate, so no key gathers its versions in one place. Of several new (or several old) ones of a key, the one
    generated last wins, then the larger id, then the larger of the other fields in their order.
    """
    tagged = history.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    fields = new.columns
    newest = tagged.groupBy("alert_type", "batch").agg(
        F.max_by(F.struct(*fields), F.struct("__new", "generated_timestamp", "alert_id", *fields)).alias("alert")
    )
    return in_alert_order(newest.select(*[F.col(f"alert.{f}").alias(f) for f in fields]))


def severity_rank(severity: Column) -> Column:
    ladder = F.lit(None).cast("int")
    for rank, name in enumerate(rules.SEVERITIES):
        ladder = F.when(severity == name, rank).otherwise(ladder)
    return ladder


def week_status(weeks: DataFrame, alerts: DataFrame) -> DataFrame:
    """Highest severity that applies to each week: its own alerts and the health alert of the month it starts in.

    Each week looks up two keys, its date and its month, so a single equi join replaces the OR condition.
    """
    week, month = F.col("week"), F.substring("week", 1, 7)
    keys = weeks.select("week", "behavioral_similarity_score", F.explode(F.array(week, month)).alias("key"))
    found = alerts.select(
        F.col("batch").alias("key"), "alert_type", "alert_id", "batch_timestamp", "severity", "trigger"
    )
    own = (F.col("key") == F.col("week")) | (F.col("alert_type") == rules.DATA_HEALTH)
    applicable = keys.join(found, "key", "left").withColumn("applies", F.coalesce(own, F.lit(False)))
    order = F.struct((-severity_rank(F.col("severity"))).alias("rank"), "batch_timestamp", "alert_id")
    shown = F.when(F.col("applies") & F.col("severity").isNotNull(), F.struct("severity", "trigger"))
    worst = applicable.groupBy("week", "behavioral_similarity_score").agg(
        F.min_by(shown, F.when(shown.isNotNull(), order)).alias("worst"),
        F.count(shown).alias("applicable_alerts"),
    )
    return worst.select(
        "week", "behavioral_similarity_score",
        F.coalesce("worst.severity", F.lit(rules.SEVERITIES[0])).alias("status"),
        F.col("worst.trigger").alias("trigger"), "applicable_alerts",
    )


def short_reason(reason: Column, limit: int = rules.REASON_LIMIT) -> Column:
    cut = F.regexp_replace(F.substring(reason, 1, limit - 1), r"\s+$", "")
    return (
        F.when(reason.isNull() | (reason == ""), rules.NO_REASON)
        .when(F.length(reason) <= limit, reason)
        .otherwise(F.concat(cut, F.lit("…")))
    )


def alert_listing(alerts: DataFrame) -> DataFrame:
    """Alert history for display, newest batch first."""
    return alerts.orderBy(F.desc("batch_timestamp"), F.desc("alert_id")).select(
        "alert_id", "batch", F.col("alert_type").alias("type"), "severity",
        F.col("similarity_score").alias("similarity"), short_reason(F.col("trigger")).alias("reason"),
        F.col("generated_timestamp").alias("generated"),
    )
