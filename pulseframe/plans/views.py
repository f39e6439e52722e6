"""The tables behind the monitoring screens, as small queries over the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import rules

LATEST = "latest"


def feature_label(feature: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in rules.FEATURE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, feature), feature)


def overview(health: DataFrame, weeks: DataFrame) -> DataFrame:
    """Total records over all months and the number of weekly batches, as one row."""
    return health.agg(F.sum("total_records").alias("total_records")).select(
        "total_records", weeks.agg(F.count(F.lit(1))).scalar().alias("weekly_batches")
    )


def monthly_trend(health: DataFrame, batch: str = "batch") -> DataFrame:
    return health.select(F.col(batch).alias("month"), "health_score", "total_records").orderBy("month")


def month_missing(health: DataFrame, month: str | None = None, batch: str = "batch") -> DataFrame:
    """Missing table of one month, or of each."""
    return _of_month(health, month, batch).select(F.col(batch).alias("month"), F.inline("missing"))


def month_numeric(health: DataFrame, month: str | None = None, batch: str = "batch") -> DataFrame:
    return _of_month(health, month, batch).select(F.col(batch).alias("month"), F.inline("numeric"))


def month_outliers(health: DataFrame, month: str | None = None, batch: str = "batch") -> DataFrame:
    """IQR table with the schema message of the month."""
    message = F.when(F.col("schema_drift.detected"), rules.ANOMALY_SCHEMA).otherwise(rules.NO_SCHEMA_DRIFT)
    rows = _of_month(health, month, batch).select(
        F.col(batch).alias("month"), message.alias("schema_message"), F.explode("outliers").alias("o")
    )
    return rows.select("month", "schema_message", "o.column", "o.q1", "o.q3", "o.outlier_percentage")


def _of_month(health: DataFrame, month: str | None, batch: str) -> DataFrame:
    """``month`` is a label, ``LATEST``, or None for every month."""
    if month is None:
        return health
    return health.filter(F.col(batch) == (health.agg(F.max(batch)).scalar() if month == LATEST else F.lit(month)))


def labelled_deviations(scores: DataFrame, week: str | None = None) -> DataFrame:
    """Top deviations with display labels, best first within a week."""
    rows = _of_week(scores, week).select(
        "week_start", F.posexplode("top_deviating_features").alias("position", "f")
    )
    return rows.select(
        "week_start", (F.col("position") + 1).alias("rank"), feature_label(F.col("f.feature")).alias("feature"),
        F.col("f.z_score").alias("z_score"), F.col("f.current").alias("current"),
        F.col("f.baseline_mean").alias("baseline_mean"),
    )


def week_comparison(comparison: DataFrame, week: str | None = None) -> DataFrame:
    """Current value against baseline for every feature of one week, or of each."""
    return _of_week(comparison, week).select(
        "week_start", feature_label(F.col("feature")).alias("feature"), "current", "baseline_mean",
        "baseline_stddev", "z_score",
    )


def _of_week(rows: DataFrame, week: str | None) -> DataFrame:
    """``week`` is a date as text, ``LATEST``, or None for every week."""
    if week is None:
        return rows
    chosen = rows.agg(F.max("week_start")).scalar() if week == LATEST else F.lit(week).cast("date")
    return rows.filter(F.col("week_start") == chosen)


def week_message(scores: DataFrame, week: str | None = None) -> DataFrame:
    """What a week's drift status means, as a severity and a sentence."""
    status, severity, sentence = F.col("drift_status"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for names, level, text in rules.WEEK_MESSAGES:
        severity = F.when(status.isin(list(names)), level).otherwise(severity)
        sentence = F.when(status.isin(list(names)), text).otherwise(sentence)
    return _of_week(scores, week).select(
        "week_start", "drift_status", severity.alias("severity"), sentence.alias("message"), "source_window_note"
    )


def weekly_trend(scores: DataFrame) -> DataFrame:
    return scores.select("week_start", "behavioral_similarity_score").orderBy("week_start")
