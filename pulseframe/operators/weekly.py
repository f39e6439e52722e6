"""Weekly behaviour features, their prior-only baseline and the drift scores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseframe import rules
from pulseframe.functions import c, percent, sprintf, week_start
from pulseframe.operators.cleaning import with_week
from pulseframe.operators.duplicates import duplicate_rows, duplicates_of_spans
from pulseframe.operators.missing import missing_count_aggregates, missing_total, source_columns
from pulseframe.rules import DriftRules, Roles

FEATURES = list(rules.FEATURE_LABELS)
WEEK = "week_start"


def weekly_features(
    df: DataFrame, roles: Roles = Roles(), *, approximate: bool = False, identity: str = "digest",
    daily: DataFrame | None = None,
) -> DataFrame:
    """One row per week: the eleven features plus the first and last source date inside the week.

    Fixed-size measures, the four distinct counts, and the row-identity shuffle for duplicates, joined on the week. They
    stay apart on purpose. Together with the distinct counts every (week, value) entry of the shuffle would carry the
    buffers of all measures, and a task would hold the values of four columns at once (see ``distinct_values``). ``df`` is
    read for each of them, so it should be a stored table. ``approximate`` trades the exact distinct counts for sketches,
    which need one pass and no shuffle of values. ``daily``, the ``daily_copies`` of the same rows, takes the place of the
    row-identity shuffle.
    """
    weeks = with_week(df, roles.date, WEEK)
    columns = source_columns(weeks, [WEEK])
    quantity, price, day = c(roles.quantity).cast("double"), c(roles.price).cast("double"), c(roles.date)
    counted = {
        "survey_response_diversity": roles.entity, "unique_product_code_count": roles.product,
        "unique_category_count": roles.category, "unique_shipping_state_count": roles.region,
    }

    measures = weeks.groupBy(WEEK).agg(
        F.count(F.lit(1)).alias("purchase_record_count"),
        F.avg(quantity).alias("average_quantity"),
        F.stddev_samp(quantity).alias("quantity_stddev"),
        F.avg(price).alias("average_purchase_price_per_unit"),
        F.stddev_samp(price).alias("purchase_price_per_unit_stddev"),
        F.min(day).cast("date").alias("first_date"),
        F.max(day).cast("date").alias("last_date"),
        *missing_count_aggregates(weeks, columns),
    )
    if approximate:
        variety = weeks.groupBy(WEEK).agg(*[F.approx_count_distinct(c(n)).alias(f) for f, n in counted.items()])
    else:
        variety = distinct_values(weeks, counted)
    if daily is None:
        duplicated = duplicate_rows(weeks, [WEEK], identity, digits=None)
    else:
        duplicated = duplicates_of_spans(daily, week_start(F.col("day")), WEEK, digits=None)
    copies = duplicated.select(WEEK, F.col("duplicate_percentage").alias("duplicate_rate"))
    rate = percent(missing_total(columns), F.col("purchase_record_count") * len(columns))
    feature = lambda name: rate if name == "missing_value_rate" else F.col(name).cast("double")
    return measures.join(variety, WEEK).join(copies, WEEK).select(
        WEEK, *[feature(f).alias(f) for f in FEATURES], "first_date", "last_date"
    )


def distinct_values(weeks: DataFrame, counted: Mapping[str, str]) -> DataFrame:
    """One row per week with the number of distinct non-NULL values of columns; ``counted`` maps names to columns.

    Each column is read and counted by itself, over (week, value) entries. With several distinct counts in one aggregation
    a task holds an entry of all columns for every value of any, the largest state of the weekly plans.
    """
    parts = [
        weeks.select(WEEK, c(column).alias("value")).distinct().groupBy(WEEK)
        .agg(F.count("value").alias("found")).select(WEEK, F.lit(name).alias("name"), "found")
        for name, column in counted.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(WEEK).agg(
        *[F.max(F.when(F.col("name") == name, F.col("found"))).alias(name) for name in counted]
    )


def week_dates(df: DataFrame, date_column: str) -> DataFrame:
    """First and last date of every week, from a scan of the dates alone."""
    day = c(date_column)
    return with_week(df, date_column, WEEK).groupBy(WEEK).agg(
        F.min(day).cast("date").alias("first_date"), F.max(day).cast("date").alias("last_date")
    )


def partial_week_columns(period: str, first: Column, last: Column) -> tuple[Column, Column]:
    """Flag and note of a week that the source, running from ``first`` to ``last``, covers only in part."""
    day = lambda value: F.date_format(value, "yyyy-MM-dd")
    cut_front = (week_start(first) == F.col(WEEK)) & (first > F.col(WEEK))
    cut_back = (week_start(last) == F.col(WEEK)) & (last < F.date_add(F.col(WEEK), 6))
    note = (
        F.when(cut_front & cut_back, F.lit(rules.NOTE_BOTH_ENDS % period))
        .when(cut_front, sprintf(rules.NOTE_FIRST_WEEK, F.lit(period), day(first)))
        .when(cut_back, sprintf(rules.NOTE_LAST_WEEK, F.lit(period), day(last)))
    )
    return cut_front | cut_back, note


def partial_weeks(features: DataFrame, period: str = DriftRules.period) -> DataFrame:
    """The weekly rows with ``is_partial_source_window`` and ``source_window_note``."""
    everything = Window.partitionBy()
    first, last = F.min("first_date").over(everything), F.max("last_date").over(everything)
    spanned = features.withColumn("__first", first).withColumn("__last", last)
    flag, note = partial_week_columns(period, F.col("__first"), F.col("__last"))
    return (
        spanned.withColumn("is_partial_source_window", flag)
        .withColumn("source_window_note", note)
        .drop("__first", "__last")
    )


def z_score(current: Column, mean: Column, stddev: Column, observations: Column, limits: DriftRules) -> Column:
    """Distance from the baseline in standard deviations; see ``DriftRules`` for the edge cases."""
    deviation = F.abs(current - mean)
    flat = F.when(deviation <= limits.zero_variance_epsilon, 0.0)
    flat = flat.when(current.isNull(), F.lit(None)) if limits.null_feature == "skip" else flat
    return F.when(
        (observations >= limits.min_history_weeks) & stddev.isNotNull(),
        F.when(stddev > limits.zero_variance_epsilon, deviation / stddev).otherwise(flat.otherwise(limits.max_z)),
    ).cast("double")


def compare_to_history(features: DataFrame, limits: DriftRules = DriftRules()) -> DataFrame:
    """Long table, one row per week and feature: current value, prior-only baseline and z-score.

    One expression serves all features because the table is long. The windows run per feature over one row per
    week, so their size follows the calendar and not the facts.
    """
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).alias("current"))
        for i, f in enumerate(FEATURES)
    ])
    tall = features.select(WEEK, "first_date", "last_date", F.inline(entries))
    own = Window.partitionBy("feature")
    before = own.orderBy(WEEK).rowsBetween(Window.unboundedPreceding, -1)
    with_baseline = tall.withColumns({
        "historical_observations": F.count(F.lit(1)).over(before),
        "baseline_mean": F.avg("current").over(before),
        "baseline_stddev": F.stddev_samp("current").over(before),
        "__first": F.min("first_date").over(own),
        "__last": F.max("last_date").over(own),
    })
    flag, note = partial_week_columns(limits.period, F.col("__first"), F.col("__last"))
    z = z_score(
        F.col("current"), F.col("baseline_mean"), F.col("baseline_stddev"), F.col("historical_observations"), limits
    )
    return with_baseline.select(
        WEEK, "position", "feature", "current", "historical_observations", "baseline_mean", "baseline_stddev",
        F.when(~(flag & (F.col("feature") == rules.VOLUME_FEATURE)), z).alias("z_score"),
        flag.alias("is_partial_source_window"), note.alias("source_window_note"),
    )


def drift_status(score: Column, observations: Column, limits: DriftRules) -> Column:
    return (
        F.when(observations < limits.min_history_weeks, rules.BASELINE_BUILDING)
        .when(score.isNull(), rules.INSUFFICIENT_HISTORY)
        .when(score >= limits.normal_from, rules.NORMAL)
        .when(score >= limits.moderate_from, rules.MODERATE_DRIFT)
        .otherwise(rules.MAJOR_DRIFT)
    )


def weekly_drift(comparison: DataFrame, limits: DriftRules = DriftRules()) -> DataFrame:
    """One row per week: scored features, distance, similarity, status, and the feature rows as an array.

    The array holds one entry per feature, in feature order.
    """
    capped = F.when(F.col("z_score").isNotNull(), F.least("z_score", F.lit(limits.max_z)))
    weeks = comparison.groupBy(WEEK).agg(
        F.max("is_partial_source_window").alias("is_partial_source_window"),
        F.max("source_window_note").alias("source_window_note"),
        F.max("historical_observations").alias("historical_observations"),
        F.count("z_score").alias("similarity_scored_feature_count"),
        F.avg(capped).alias("behavioral_distance"),
        F.array_sort(F.collect_list(F.struct(
            "position", "feature", "current", "baseline_mean", "baseline_stddev", "z_score"
        ))).alias("features"),
    )
    enough = F.col("historical_observations") >= limits.min_history_weeks
    similarity = F.greatest(F.lit(0.0), F.lit(100.0) - F.col("behavioral_distance") * limits.points_per_z)
    scored = F.when(enough & F.col("behavioral_distance").isNotNull(), F.round(similarity, 2))
    return weeks.withColumns({
        "baseline_ready": enough,
        "behavioral_similarity_score": scored,
        "drift_status": drift_status(scored, F.col("historical_observations"), limits),
        "top_deviating_features": top_features(limits.top_features),
    })


def top_features(count: int) -> Column:
    """The ``count`` largest z-scores of a week's feature array; ties keep feature order, NULLs stay out."""
    ranked = F.array_sort(F.transform(
        F.filter("features", lambda f: f["z_score"].isNotNull()),
        lambda f: F.struct((-f["z_score"]).alias("falling"), f["position"].alias("position"), f.alias("item")),
    ))
    return F.transform(F.slice(ranked, 1, count), lambda r: F.struct(*[
        r["item"][n].alias(n) for n in ("feature", "z_score", "current", "baseline_mean")
    ]))
