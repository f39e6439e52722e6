"""Cleaning and validation of a dated source table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Row, functions as F

from pulseframe.functions import blank_as_null, c, month_key, month_label, week_start


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn empty and space-only strings of the named columns into NULL, in one projection."""
    chosen = set(columns)
    return df.select(*[blank_as_null(n) if n in chosen else c(n) for n in df.columns])


def keep_year(df: DataFrame, date_column: str, year: int) -> DataFrame:
    """One calendar year, written as a range so that it reaches the Parquet scan."""
    day = c(date_column)
    return df.filter((day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1))))


def validation_summary(df: DataFrame, date_column: str, year: int | None = None) -> DataFrame:
    """One row: rows without a usable date in the whole table, then count and date range of the kept year.

    All four figures come from one aggregation that reads only the date column.
    """
    return df.agg(*summary_aggregates(df, date_column, year))


def summary_aggregates(df: DataFrame, date_column: str, year: int | None = None) -> list[Column]:
    """The figures of ``validation_summary`` as aggregates, to be observed while the rows pass."""
    day = c(date_column)
    kept = day.isNotNull()
    if year is not None:
        kept = (day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1)))
    return [
        F.count_if(day.isNull()).alias("invalid_dates"),
        F.count_if(kept).alias("records"),
        F.min(F.when(kept, day)).alias("earliest_date"),
        F.max(F.when(kept, day)).alias("latest_date"),
    ]


def check_dates(summary: DataFrame, date_column: str, what: str) -> None:
    """Raise if the one-row ``validation_summary`` shows bad dates or an empty result."""
    check_figures(summary.first(), date_column, what)


def check_figures(row: Mapping[str, Any] | Row, date_column: str, what: str) -> None:
    """The same for figures already at hand."""
    if row["invalid_dates"]:
        raise ValueError(f"Found {row['invalid_dates']} null or unparseable {date_column} values.")
    if not row["records"]:
        raise ValueError(f"No {what} records were found.")


def with_month(df: DataFrame, date_column: str, name: str = "batch") -> DataFrame:
    """Add the month key, a DATE; rows without a date belong to no batch and are dropped."""
    return df.filter(c(date_column).isNotNull()).withColumn(name, month_key(c(date_column)))


def with_month_label(batches: DataFrame, name: str = "batch") -> DataFrame:
    """Render the month key of a result as ``yyyy-MM``."""
    return batches.withColumn(name, month_label(c(name)))


def with_week(df: DataFrame, date_column: str, name: str = "week_start") -> DataFrame:
    return df.filter(c(date_column).isNotNull()).withColumn(name, week_start(c(date_column)))


def in_date_ranges(
    df: DataFrame, date_column: str, spread: Iterable[str], parts: int = 8, partitions: int | None = None
) -> DataFrame:
    """Lay rows out by month before they are written, sorted by date within a task.

    Costs one shuffle of one evaluation of ``df`` (range partitioning would evaluate it a second time to sample it).
    Afterwards a task sees few weeks or months, so the partial aggregates, distinct values and quartile sketches of
    every later plan fold before they are shuffled, and date filters skip whole row groups. ``spread`` names columns
    that tell the rows of one month apart, best a key of the source: every month is split into ``parts`` by their
    hash, so a hot month goes to several tasks. Rows that agree in all of them stay together.
    """
    part = F.pmod(F.xxhash64(*[c(n) for n in spread]), F.lit(parts))
    by = [month_key(c(date_column)), part]
    dealt = df.repartition(partitions, *by) if partitions else df.repartition(*by)
    return dealt.sortWithinPartitions(c(date_column))
