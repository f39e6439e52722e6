"""Append-only store of dataset reports. The analysed data itself is never kept."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe import rules


def save_report(report: DataFrame, path: str, saved_at: datetime | None = None) -> str:
    """Append a report and return its id."""
    report_id = uuid.uuid4().hex
    moment = saved_at or datetime.now(timezone.utc)
    stamped(report, moment).withColumn("report_id", F.lit(report_id)).write.mode("append").parquet(path)
    return report_id


def stamped(report: DataFrame, saved_at: datetime) -> DataFrame:
    return report.withColumn("saved_at", F.lit(saved_at)).withColumn("report_type", F.lit(rules.REPORT_TYPE))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def recent_reports(reports: DataFrame, limit: int = 10) -> DataFrame:
    """The newest reports in short form. Sort and limit run as one top-k, six columns wide."""
    return reports.select(
        F.coalesce("file_name", F.lit(rules.UNKNOWN_FILE)).alias("file_name"),
        "saved_at", "data_health_score", "health_status", "row_count", "column_count",
    ).orderBy(F.desc("saved_at"), "file_name").limit(limit)
