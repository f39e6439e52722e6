"""One-row health report of any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import rules
from pulseframe.functions import attach, c, percent
from pulseframe.operators import health
from pulseframe.operators.duplicates import duplicate_rows
from pulseframe.operators.missing import missing_array, missing_count_aggregates, missing_total
from pulseframe.operators.numeric import (
    long_values, numeric_aggregates, numeric_array, numeric_columns, outlier_summary,
)
from pulseframe.operators.schema import date_column, schema_snapshot
from pulseframe.rules import DatasetRules

REPORT_FIELDS = [
    "file_name", "row_count", "column_count", "schema_overview", "missing_by_column", "total_missing_values",
    "overall_missing_percentage", "duplicate_row_count", "duplicate_percentage", "numerical_summary",
    "outlier_analysis", "detected_issues", "data_health_score", "health_status", "date_detection_message",
    "has_valid_rows", "has_readable_columns",
]


def date_message(df: DataFrame) -> Column:
    found = date_column(df)
    return F.lit(rules.DATE_COLUMN_FOUND % found if found else None).cast("string")


def analysed_outliers(outliers: Column, limits: DatasetRules) -> Column:
    """Columns worth analysing, with the figures rounded for display."""
    usable = F.filter(
        outliers, lambda o: (o["valid_count"] >= limits.min_outlier_values) & (o["iqr"] > 0)
    )
    return F.transform(usable, lambda o: F.struct(
        o["column"].alias("column"),
        *[F.round(o[n], 4).alias(n) for n in ("q1", "q3", "lower_bound", "upper_bound")],
        o["valid_count"].alias("valid_count"),
        o["outlier_count"].alias("outlier_count"),
        o["outlier_percentage"].alias("outlier_percentage"),
    ))


def dataset_outliers(df: DataFrame, columns: list[str] | None = None, limits: DatasetRules = DatasetRules()) -> DataFrame:
    """Long IQR table of the analysed columns of a whole table."""
    chosen = numeric_columns(df) if columns is None else columns
    summary = outlier_summary(
        df, chosen, denominator="valid", accuracy=limits.quartile_accuracy,
        exact=limits.exact_quartiles, fence=limits.fence_width, digits=2
    )
    return summary.select(F.inline(analysed_outliers(F.col("outliers"), limits)))


def datasets_outliers(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], limits: DatasetRules = DatasetRules()
) -> DataFrame:
    """The long IQR tables of several tables, measured in the passes of one."""
    summary = outlier_summary(
        long_values(tables, columns), ["value"], ["table_name", "column_name"], denominator="valid",
        max_groups=sum(map(len, columns.values())), accuracy=limits.quartile_accuracy,
        exact=limits.exact_quartiles, fence=limits.fence_width, digits=2,
    )
    found = summary.select("table_name", "column_name", F.inline(analysed_outliers(F.col("outliers"), limits)))
    return found.drop("column").withColumnRenamed("column_name", "column")


def dataset_report(
    df: DataFrame, name: str, limits: DatasetRules = DatasetRules(), *, identity: str = "digest"
) -> DataFrame:
    """All measures, issues, score and status of ``df`` as a single row with nested arrays.

    The table is read five times, each time with the columns that pass needs: fixed-size measures, quartiles (twice),
    outlier counts, and row identity. The one-row results meet as scalar subqueries.
    """
    columns, numeric = df.columns, numeric_columns(df)
    total = missing_total(columns)
    plain = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *missing_count_aggregates(df, columns, blank_is_missing=True),
        *numeric_aggregates(numeric),
    ).select(
        "row_count",
        missing_array(columns, F.col("row_count"), 2).alias("missing_by_column"),
        total.alias("total_missing_values"),
        percent(total, F.col("row_count") * len(columns), 2).alias("overall_missing_percentage"),
        numeric_array(numeric, "valid").alias("numerical_summary"),
    )
    outliers = outlier_summary(
        df, numeric, denominator="valid", accuracy=limits.quartile_accuracy,
        exact=limits.exact_quartiles, fence=limits.fence_width, digits=2
    )
    measured = attach(plain, outliers, [])
    if columns:
        copies = duplicate_rows(df, identity=identity, digits=2).select(
            F.col("duplicate_records").alias("duplicate_row_count"), "duplicate_percentage"
        )
        measured = attach(measured, copies, [])
    else:
        measured = measured.withColumns({
            "duplicate_row_count": F.lit(0).cast("bigint"), "duplicate_percentage": F.lit(0.0)})

    zero = F.lit(0).cast("bigint")
    summed = lambda name: F.aggregate("outlier_analysis", zero, lambda acc, o: acc + o[name])
    overview = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in schema_snapshot(df).items()
    ]).cast("array<struct<column_name:string,data_type:string>>")
    usable = (F.col("row_count") > 0) & F.lit(bool(columns))
    measures = [F.col(n) for n in (
        "overall_missing_percentage", "duplicate_percentage", "overall_outlier_percentage")]
    return (
        measured.withColumn("outlier_analysis", analysed_outliers(F.col("outliers"), limits))
        .withColumn("overall_outlier_percentage", percent(summed("outlier_count"), summed("valid_count"), 2))
        .withColumns({
            "file_name": F.lit(name),
            "column_count": F.lit(len(columns)),
            "schema_overview": overview,
            "date_detection_message": date_message(df),
            "has_valid_rows": usable,
            "has_readable_columns": F.lit(bool(columns)),
            "data_health_score": health.dataset_score(*measures, usable, limits),
            "detected_issues": health.dataset_issues(*measures, usable, limits),
        })
        .withColumn("health_status", health.dataset_status(F.col("data_health_score"), limits))
        .select(*REPORT_FIELDS, "overall_outlier_percentage")
    )
