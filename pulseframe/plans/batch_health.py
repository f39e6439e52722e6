"""Health of every month of a dated table, or of one batch on its own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from pulseframe.functions import CALENDAR_MONTHS, attach, c, percent
from pulseframe.operators.cleaning import with_month_label
from pulseframe.operators.duplicates import duplicate_rows
from pulseframe.operators.health import growth_rate, with_batch_score, with_growth
from pulseframe.operators.missing import (
    missing_array, missing_count_aggregates, missing_total, source_columns,
)
from pulseframe.operators.numeric import numeric_aggregates, numeric_array, outlier_summary
from pulseframe.operators.schema import drift_literal, schema_snapshot
from pulseframe.rules import HealthRules

FINGERPRINT_FIELDS = [
    "total_records", "total_columns", "missing_percentage", "total_missing", "missing_values_per_column",
    "missing_percentage_per_column", "duplicate_records", "duplicate_percentage", "growth_rate",
    "numerical_statistics", "data_quality_anomalies", "outlier_analysis", "schema", "schema_drift", "health_score",
    "health_status", "severity", "deductions",
]


def profile_batches(
    df: DataFrame,
    numeric: Sequence[str],
    by: Sequence[str] = (),
    *,
    limits: HealthRules = HealthRules(),
    denominator: str = "records",
    max_groups: int | None = None,
    identity: str = "digest",
    copies: DataFrame | None = None,
) -> DataFrame:
    """Counts, missing values, numeric statistics, outliers and duplicates: one row per batch.

    Three aggregations meet on the batch key: (1) one generated-code pass with every fixed-size measure,
    (2) quartile sketches followed by the outlier count over the numeric columns alone, (3) the row-identity
    shuffle for duplicates. Each scan reads only the columns it needs and only (3) moves data in bulk.
    ``copies``, the result of ``duplicate_rows`` for the same batches, takes the place of (3).
    """
    columns = source_columns(df, by)
    keys = [c(k) for k in by]
    records = F.col("total_records")
    total = missing_total(columns)
    plain = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            *missing_count_aggregates(df, columns),
            *numeric_aggregates(numeric),
        )
        .select(
            *keys,
            records,
            F.lit(len(columns)).alias("total_columns"),
            total.alias("total_missing"),
            percent(total, records * len(columns), 4).alias("missing_percentage"),
            missing_array(columns, records, 4).alias("missing"),
            numeric_array(numeric, denominator, records).alias("numeric"),
        )
    )
    outliers = outlier_summary(
        df, numeric, by, max_groups=max_groups, denominator=denominator,
        accuracy=limits.quartile_accuracy,
        exact=limits.exact_quartiles, fence=limits.fence_width,
    )
    copied = duplicate_rows(df, by, identity) if copies is None else copies
    return attach(attach(plain, outliers, by), copied.drop("total_records", "unique_records"), by)


def batch_health(
    df: DataFrame,
    numeric: Sequence[str],
    batch: str = "batch",
    *,
    limits: HealthRules = HealthRules(),
    schema_changes: DataFrame | None = None,
    monthly: bool = False,
    max_batches: int | None = None,
    identity: str = "digest",
    copies: DataFrame | None = None,
) -> DataFrame:
    """One row per batch with profile, growth, schema drift, anomalies, deductions, score and status.

    ``monthly`` says that the batch column is a month key as ``with_month`` adds it: it comes out as ``yyyy-MM``,
    and the calendar bounds the number of batches. Any other batch column stays as it is, with no bound but
    ``max_batches``. Growth follows the order of the raw key.
    ``schema_changes`` is the output of ``schema_drift`` over the batches' own schemas. Without it every batch
    has the schema of ``df`` and the first batch is the baseline. ``copies`` as in ``profile_batches``.
    """
    bound = CALENDAR_MONTHS if monthly and max_batches is None else max_batches
    profiled = profile_batches(
        df, numeric, [batch], limits=limits, max_groups=bound, identity=identity, copies=copies)
    grown = with_growth(profiled, batch)
    if monthly:
        grown = with_month_label(grown, batch)
    snapshot = schema_snapshot(df, [batch])
    same, first = drift_literal(snapshot, snapshot), drift_literal(None, snapshot)
    if schema_changes is None:
        drifted = grown.withColumn("schema_drift", F.when(F.col("previous_records").isNull(), first).otherwise(same))
    else:
        change = F.struct("detected", "baseline", "added_columns", "removed_columns", "changed_data_types")
        drifted = grown.join(
            schema_changes.select(F.col("batch").alias(batch), change.alias("schema_drift")), batch, "left"
        )
    return with_batch_score(drifted, limits)


def single_batch_health(
    df: DataFrame,
    name: str,
    numeric: Sequence[str],
    previous_records: int | None = None,
    previous_schema: Mapping[str, str] | None = None,
    *,
    batch: str = "batch",
    limits: HealthRules = HealthRules(),
    identity: str = "digest",
) -> DataFrame:
    """The same row for one batch, compared with an optional earlier record count and schema.

    Counts and outlier percentages refer to the non-NULL values; numeric columns the batch lacks are left out.
    """
    table = df.drop(batch)
    present = [n for n in numeric if n in table.columns]
    profiled = profile_batches(table, present, limits=limits, denominator="valid", identity=identity)
    previous = F.lit(previous_records).cast("bigint")
    drift = drift_literal(previous_schema, schema_snapshot(table))
    compared = profiled.withColumns({
        batch: F.lit(name),
        "previous_records": previous,
        "growth_rate": growth_rate(F.col("total_records"), previous),
        "schema_drift": drift,
    })
    return with_batch_score(compared, limits)


def health_documents(health: DataFrame, snapshot: Mapping[str, str], batch: str = "batch") -> DataFrame:
    """The nested fingerprint of each batch, with maps keyed by column, ready for the JSON sink."""
    by_column = lambda array, value: F.map_from_entries(
        F.transform(array, lambda item: F.struct(item["column"], value(item)))
    )
    stats = lambda item: F.struct(*[item[n].alias(n) for n in ("count", "mean", "stddev", "min", "max")])
    fences = lambda item: F.struct(*[
        item[n].alias(n)
        for n in ("q1", "q3", "iqr", "lower_bound", "upper_bound", "outlier_count", "outlier_percentage")
    ])
    schema_map = F.map_from_arrays(
        F.array(*[F.lit(n) for n in snapshot]), F.array(*[F.lit(t) for t in snapshot.values()])
    )
    derived = {
        "missing_values_per_column": by_column("missing", lambda m: m["missing_count"]),
        "missing_percentage_per_column": by_column("missing", lambda m: m["missing_percentage"]),
        "numerical_statistics": by_column("numeric", stats),
        "outlier_analysis": by_column("outliers", fences),
        "schema": schema_map,
        "severity": F.col("health_status"),
    }
    return health.select(
        c(batch).alias("month"), *[derived[f].alias(f) if f in derived else F.col(f) for f in FINGERPRINT_FIELDS]
    )
