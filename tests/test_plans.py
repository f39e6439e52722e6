"""The physical plans at the points that decide whether they scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pulseframe.functions import CALENDAR_MONTHS, fits_broadcast
from pulseframe.functions.joins import SALTS, join_split
from pulseframe.operators import cleaning, duplicates, missing, numeric, weekly
from pulseframe.plans.batch_health import batch_health, profile_batches
from workload import monthly
from workload.weekly import queries as weekly_queries
from workload.tables import DRIFT, ROLES, purchases, table

CHECKED = sorted({**monthly.queries(), **weekly_queries()})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dataset_report_has_no_join_at_all(spark, sf_dir):
    text = plan(monthly.reports(spark, sf_dir)[0])
    assert "Join" not in text and "Subquery" in text


def test_year_filter_reaches_the_scan(spark, sf_dir):
    text = plan(cleaning.keep_year(purchases(spark, sf_dir), ROLES.date, 1998))
    assert "GreaterThanOrEqual(order_date,1998-01-01)" in text and "LessThan(order_date,1999-01-01)" in text


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_quartiles_and_outliers_read_only_their_columns(spark, sf_dir):
    found = numeric.iqr_outliers(monthly.monthly(spark, sf_dir), ["quantity"], ["batch"], max_groups=CALENDAR_MONTHS)
    assert set(read_schemas(plan(found))) == {"order_date:date,quantity:double"}


def test_validation_reads_only_the_date(spark, sf_dir):
    assert read_schemas(plan(cleaning.validation_summary(purchases(spark, sf_dir), ROLES.date, 1998))) == [
        "order_date:date"]


def test_fences_are_broadcast_only_under_a_proven_bound(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    assert "__salt" in plan(numeric.iqr_outliers(events, ["value"], ["event_type"], broadcast_bytes=0))
    assert "__salt" in plan(numeric.iqr_outliers(events, ["value"], ["event_type"]))
    assert "__salt" not in plan(numeric.iqr_outliers(events, ["value"], ["event_type"], max_groups=8))
    bounds = numeric.quartile_bounds(events, ["value"], ["event_type"])
    assert not fits_broadcast(bounds, None)
    assert not fits_broadcast(bounds, 10**9)
    assert fits_broadcast(bounds, CALENDAR_MONTHS)


def test_only_a_month_key_bounds_the_batches(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "value")
    assert "__salt" in plan(batch_health(events, ["value"], "event_type"))
    assert "__salt" not in plan(batch_health(monthly.monthly(spark, sf_dir), ["quantity"], monthly=True))


def test_only_hot_keys_are_copied(spark):
    rows = [("hot", float(n)) for n in range(900)] + [(f"cold{n}", float(n)) for n in range(100)]
    large = spark.createDataFrame(rows, "k string, v double").repartition(4)
    small = large.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    joined = join_split(large, small, ["k"], "n")
    assert joined.columns == ["k", "v", "top"] and joined.count() == 1000
    copies = plan(joined)
    assert copies.count("explode") >= 1
    spread = small.withColumn("copies", F.when(F.col("n") * SALTS > 1000, SALTS).otherwise(1))
    assert spread.agg(F.sum("copies")).collect()[0][0] == 100 + SALTS


def test_screens_and_alerts_read_results_and_not_facts(spark, sf_dir):
    for name in ("overview", "monthly_trend", "month_missing", "month_numeric", "month_iqr", "weekly_trend",
                 "alert_listing", "week_status", "week_comparison", "labelled_deviations", "latest_month_missing"):
        text = plan(contract.queries()[name](spark, sf_dir))
        assert "lineitem" not in text and "/purchases-" not in text, name


def test_scans_of_the_releases_do_not_grow_with_their_number(spark, sf_dir):
    profiled = profile_batches(monthly.released(spark, sf_dir), monthly.NUMERIC, ["batch"], max_groups=CALENDAR_MONTHS)
    assert plan(profiled).count("Scan parquet") <= 4
    assert plan(contract.queries()["weekly_partial_window"](spark, sf_dir)).count("Scan parquet") == 1


def test_the_layout_evaluates_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(5000).select("id", F.date_add(F.lit(date(2022, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"))
    laid = cleaning.in_date_ranges(rows.mapInArrow(counted, rows.schema), "d", ["id"])
    laid.write.format("noop").mode("overwrite").save()
    assert seen.value == 5000


def test_duplicates_combine_on_the_map_side(spark, sf_dir):
    text = plan(duplicates.duplicate_rows(purchases(spark, sf_dir)))
    assert text.count("HashAggregate") >= 4 and "SortAggregate" not in text
    digest = plan(duplicates.duplicate_rows(table(spark, sf_dir, "documents"), identity="digest"))
    assert "sha2" in digest and re.search(r"hashpartitioning\(__row0#\d+L?, __row1#\d+", digest)


def test_fixed_size_measures_stay_in_generated_code(spark, sf_dir):
    text = plan(missing.missing_summary(monthly.monthly(spark, sf_dir), ["batch"]))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_weekly_windows_run_per_feature_over_weeks(spark, sf_dir):
    comparison = weekly.compare_to_history(weekly.weekly_features(purchases(spark, sf_dir), ROLES), DRIFT)
    text = plan(comparison)
    assert re.search(r"Window \[.*\], \[feature#\d+\]", text)
    assert "SinglePartition" not in text


def test_no_python_in_any_plan(spark, sf_dir):
    for name in ("weekly_drift", "batch_health", "dataset_duplicates"):
        text = plan(contract.queries()[name](spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text
