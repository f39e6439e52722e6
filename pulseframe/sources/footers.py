"""Row count and date range of a Parquet table from its footers, without reading a row group."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe.functions import c


def footer_aggregates(spark: SparkSession, path: str, date_column: str) -> DataFrame:
    """``row_count``, ``earliest_date`` and ``latest_date``, pushed into the scan as an aggregate over the footers.

    Runs in a session of its own, as both settings belong to a session: Parquet through the newer source interface, and
    aggregates pushed into it.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return reader.read.parquet(path).agg(*_facts(date_column))


def _facts(date_column: str) -> list:
    return [
        F.count(F.lit(1)).alias("row_count"), F.min(c(date_column)).alias("earliest_date"),
        F.max(c(date_column)).alias("latest_date"),
    ]


def footer_facts(spark: SparkSession, path: str, date_column: str) -> DataFrame:
    """The same as one row. Asked for at once: files whose footers have no statistics for the column are noticed only when
    they are read, and then the column is scanned."""
    try:
        row = footer_aggregates(spark, path, date_column).first()
    except (PySparkException, Py4JJavaError):
        return spark.read.parquet(path).agg(*_facts(date_column))
    kind = spark.read.parquet(path).schema[date_column].dataType.simpleString()
    count, earliest, latest = row
    return spark.createDataFrame([(count or 0, earliest, latest)], f"row_count bigint, earliest_date {kind}, latest_date {kind}")
