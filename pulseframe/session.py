"""A Spark session with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Stable batch keys need one time zone. The fallback threshold keeps quartile sketches of many batches in hash
# aggregation: beyond it Spark would sort all input rows of a task first. The last setting spares the
# driver a stack capture per column expression while it builds a plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_settings(input_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for an input of this size: adaptive execution merges shuffle partitions but never adds any, so it
    starts from enough of them. Keys are written as ``monitoring_session`` takes them."""
    return {
        "spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(max(200, -(-input_bytes // partition_bytes))),
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def monitoring_session(app_name: str = "pulseframe", master: str | None = None, **settings: str) -> SparkSession:
    """``settings`` are extra Spark options with dots written as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
