"""Scores, status and texts of batch health and of the dataset report, as rule columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseframe import rules
from pulseframe.functions import percent, sprintf
from pulseframe.rules import DatasetRules, HealthRules
from pulseframe.sources.staging import stage


def growth_rate(records: Column, previous: Column) -> Column:
    """Percentage change against the previous batch; 0.0 without one."""
    return percent(records - previous, previous, 4)


def with_growth(batches: DataFrame, batch: str = "batch") -> DataFrame:
    """Add ``previous_records`` and ``growth_rate``.

    The window runs over one row per batch, never over facts. It has no partition, so all batches pass through one
    task: fine for calendar keys and for what a report shows; ``with_growth_in_ranges`` serves keys with any number of
    values.
    """
    previous = F.lag("total_records").over(Window.orderBy(batch))
    return batches.withColumns({
        "previous_records": previous, "growth_rate": growth_rate(F.col("total_records"), previous)
    })


def with_growth_in_ranges(batches: DataFrame, batch: str = "batch") -> DataFrame:
    """``with_growth`` for any number of batches: rows are dealt out in ranges of the batch key and written, each range is
    ordered by itself, and its first row gets the last record count of the range before it.

    One row per range passes through one task, never the batches. A NULL batch comes first, as in ``with_growth``;
    batch keys have to be distinct. Runs when it is called, because the ranges are drawn once.
    """
    part, carried, place = "__range", "__carried", "__place"
    ranged = stage(
        batches.repartitionByRange(F.col(batch).asc_nulls_first()).withColumn(part, F.spark_partition_id()), "ranges")
    last = F.max_by("total_records", F.struct(F.col(batch).isNotNull(), batch))
    ends = ranged.groupBy(part).agg(last.alias("__last"))
    before = ends.select(part, F.lag("__last").over(Window.orderBy(part)).alias(carried))
    inside = Window.partitionBy(part).orderBy(batch)
    rows = ranged.withColumns({
        "previous_records": F.lag("total_records").over(inside), place: F.row_number().over(inside)}).join(before, part)
    previous = F.when(F.col(place) == 1, F.col(carried)).otherwise(F.col("previous_records"))
    return rows.withColumn("previous_records", previous).withColumn(
        "growth_rate", growth_rate(F.col("total_records"), F.col("previous_records"))).drop(part, carried, place)


def batch_status(score: Column, limits: HealthRules) -> Column:
    return F.when(score >= limits.healthy_from, "Healthy").when(score >= limits.warning_from, "Warning").otherwise(
        "Critical"
    )


def with_batch_score(batches: DataFrame, limits: HealthRules) -> DataFrame:
    """Add anomalies, deductions, score and status to rows with ``missing``, ``outliers``,
    ``duplicate_percentage``, ``growth_rate``, ``previous_records`` and ``schema_drift``."""
    gaps = F.filter("missing", lambda m: m["missing_percentage"] > limits.missing_column_pct)
    spikes = F.filter("outliers", lambda o: o["outlier_percentage"] > limits.outlier_pct)
    copied = F.col("duplicate_percentage") > limits.duplicate_pct
    jumped = (F.coalesce(F.col("previous_records"), F.lit(0)) > 0) & (
        F.abs(F.col("growth_rate")) > limits.growth_pct
    )
    reshaped = F.col("schema_drift.detected")
    two_digits = lambda value: F.round(value, 2)
    anomalies = F.array_compact(
        F.concat(
            F.transform(gaps, lambda m: sprintf(
                rules.ANOMALY_MISSING, m["column"], two_digits(m["missing_percentage"]))),
            F.array(
                F.when(copied, sprintf(rules.ANOMALY_DUPLICATES, two_digits(F.col("duplicate_percentage")))),
                F.when(jumped, sprintf(rules.ANOMALY_GROWTH, two_digits(F.col("growth_rate")))),
            ),
            F.transform(spikes, lambda o: sprintf(
                rules.ANOMALY_OUTLIERS, o["column"], two_digits(o["outlier_percentage"]))),
            F.array(F.when(reshaped, F.lit(rules.ANOMALY_SCHEMA))),
        )
    )
    fired = [F.size(gaps) > 0, copied, jumped, F.size(spikes) > 0, reshaped]
    points = [
        limits.missing_deduction, limits.duplicate_deduction, limits.growth_deduction, limits.outlier_deduction,
        limits.schema_deduction,
    ]
    lost = sum((F.when(f, p).otherwise(0) for f, p in zip(fired, points)), F.lit(0))
    deductions = F.array_compact(F.array(*[
        F.when(f, F.lit(f"{label}: -{p}")) for f, p, label in zip(fired, points, rules.DEDUCTION_LABELS)
    ]))
    return batches.withColumns({
        "data_quality_anomalies": anomalies,
        "deductions": deductions,
        "health_score": F.greatest(F.lit(0), F.lit(100) - lost),
    }).withColumn("health_status", batch_status(F.col("health_score"), limits))


def tier_penalty(value: Column, tiers: tuple, worst: int) -> Column:
    ladder = F.when(value <= tiers[0][0], tiers[0][1])
    for upper, penalty in tiers[1:]:
        ladder = ladder.when(value <= upper, penalty)
    return ladder.otherwise(worst)


def dataset_score(missing: Column, duplicates: Column, outliers: Column, usable: Column, limits: DatasetRules) -> Column:
    lost = (
        tier_penalty(missing, limits.missing_tiers, limits.missing_worst)
        + tier_penalty(duplicates, limits.duplicate_tiers, limits.duplicate_worst)
        + tier_penalty(outliers, limits.outlier_tiers, limits.outlier_worst)
        + F.when(usable, 0).otherwise(limits.unusable_penalty)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - lost))


def dataset_issues(missing: Column, duplicates: Column, outliers: Column, usable: Column, limits: DatasetRules) -> Column:
    """The first tier of each measure is free of issues; the rest are listed, or one line that says there are none."""
    line = lambda value, tiers, text: F.when(value > tiers[0][0], sprintf(text, F.round(value, 1)))
    found = F.array_compact(F.array(
        line(missing, limits.missing_tiers, rules.ISSUE_MISSING),
        line(duplicates, limits.duplicate_tiers, rules.ISSUE_DUPLICATES),
        line(outliers, limits.outlier_tiers, rules.ISSUE_OUTLIERS),
        F.when(~usable, F.lit(rules.ISSUE_UNUSABLE)),
    ))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(rules.ISSUE_NONE)))


def dataset_status(score: Column, limits: DatasetRules) -> Column:
    return F.when(score >= limits.healthy_from, "HEALTHY").when(score >= limits.warning_from, "WARNING").otherwise(
        "CRITICAL"
    )
