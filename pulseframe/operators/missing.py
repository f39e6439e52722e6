"""Missing-value profile of a table or of each of its batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.functions import c, is_missing, percent


def source_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [n for n in df.columns if n not in by]


def missing_count_aggregates(
    df: DataFrame, columns: Sequence[str], blank_is_missing: bool = False, prefix: str = "missing__"
) -> list[Column]:
    """One conditional sum per column: all of them fold into a single map-side combined aggregation."""
    return [
        F.count_if(is_missing(df.schema[name], blank_is_missing)).alias(f"{prefix}{i}")
        for i, name in enumerate(columns)
    ]


def missing_array(columns: Sequence[str], records: Column, digits: int, prefix: str = "missing__") -> Column:
    """The counts as an array of (column, missing_count, missing_percentage) in column order."""
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"{prefix}{i}").alias("missing_count"),
            percent(F.col(f"{prefix}{i}"), records, digits).alias("missing_percentage"),
        )
        for i, name in enumerate(columns)
    ]
    return F.array(*entries).cast("array<struct<column:string,missing_count:bigint,missing_percentage:double>>")


def missing_total(columns: Sequence[str], prefix: str = "missing__") -> Column:
    return sum((F.col(f"{prefix}{i}") for i in range(len(columns))), F.lit(0).cast("bigint"))


def missing_summary(
    df: DataFrame, by: Sequence[str] = (), blank_is_missing: bool = False, digits: int = 4
) -> DataFrame:
    """One row per batch: records, total and overall missing percentage, and the per-column array."""
    columns = source_columns(df, by)
    records = F.col("total_records")
    total = missing_total(columns)
    counted = df.groupBy(*[c(k) for k in by]).agg(
        F.count(F.lit(1)).alias("total_records"), *missing_count_aggregates(df, columns, blank_is_missing)
    )
    return counted.select(
        *[c(k) for k in by],
        "total_records",
        F.lit(len(columns)).alias("total_columns"),
        total.alias("total_missing"),
        percent(total, records * len(columns), digits).alias("missing_percentage"),
        missing_array(columns, records, digits).alias("missing"),
    )


def column_missing(
    df: DataFrame, by: Sequence[str] = (), blank_is_missing: bool = False, digits: int = 4
) -> DataFrame:
    """Long form of ``missing_summary``: one row per batch and column."""
    summary = missing_summary(df, by, blank_is_missing, digits)
    return summary.select(*[c(k) for k in by], F.col("total_records"), F.inline("missing"))
