"""Duplicate rows of a table or of each batch: records minus distinct full rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulseframe.functions import c, percent
from pulseframe.operators.missing import source_columns

# Length of a SHA-256 digest in hexadecimal.
DIGEST_LENGTH = 64


def row_identity(df: DataFrame, columns: Sequence[str], identity: str) -> list[Column]:
    """The columns that tell rows apart. With ``"digest"`` a text of 64 bytes or more is replaced by its SHA-256
    digest, which is 64 characters long; a shorter text stays itself, so the two cannot be confused. NULLs stay
    NULL and all other types are compared by value."""
    def key(name: str) -> Column:
        kind = df.schema[name].dataType
        if identity == "digest" and isinstance(kind, T.StringType):
            return F.when(F.octet_length(c(name)) < DIGEST_LENGTH, c(name)).otherwise(F.sha2(c(name), 256))
        if identity == "digest" and isinstance(kind, T.BinaryType):
            return F.sha2(c(name), 256)
        return c(name)

    return [key(name).alias(f"__row{i}") for i, name in enumerate(columns)]


def duplicate_rows(
    df: DataFrame, by: Sequence[str] = (), identity: str = "values", digits: int | None = 4
) -> DataFrame:
    """Records, distinct rows, duplicates and their percentage per batch.

    Copies are counted by grouping on the row itself, so the map side already folds equal rows together and a
    row repeated a billion times costs one entry per task. ``identity="digest"`` keeps long texts out of the
    shuffle (see ``row_identity``), which bounds the width of what is moved.
    """
    columns = source_columns(df, by)
    keys = [c(k) for k in by]
    rows = df.select(*keys, *row_identity(df, columns, identity))
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__copies"))
    counted = copies.groupBy(*keys).agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count(F.lit(1)).alias("unique_records"),
    )
    return _with_rate(counted, keys, digits)


def daily_copies(df: DataFrame, date_column: str, identity: str = "values") -> DataFrame:
    """``day``, records and distinct rows of every day. Rows that are equal share their day, so the figures of weeks,
    months or any span of days are sums of these (see ``duplicates_of_spans``), and one shuffle of the rows serves all.
    Rows without a date belong to no day."""
    days = df.where(c(date_column).isNotNull()).withColumn("__day", c(date_column).cast("date"))
    return duplicate_rows(days, ["__day"], identity).select(
        F.col("__day").alias("day"), "total_records", "unique_records")


def duplicates_of_spans(daily: DataFrame, span: Column, name: str, digits: int | None = 4) -> DataFrame:
    """As ``duplicate_rows`` by ``span``, an expression of ``day`` that comes out as ``name``, from ``daily_copies``."""
    counted = daily.groupBy(span.alias(name)).agg(
        F.sum("total_records").alias("total_records"), F.sum("unique_records").alias("unique_records"))
    return _with_rate(counted, [c(name)], digits)


def _with_rate(counted: DataFrame, keys: Sequence[Column], digits: int | None) -> DataFrame:
    extra = F.col("total_records") - F.col("unique_records")
    return counted.select(
        *keys, "total_records", "unique_records", extra.alias("duplicate_records"),
        percent(extra, F.col("total_records"), digits).alias("duplicate_percentage"),
    )
