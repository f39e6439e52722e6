"""What the queries over purchases move and repeat at scale."""

import glob
import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pulseframe.functions import month_key, week_start
from pulseframe.operators import distinct_state, duplicates
from pulseframe.operators.cleaning import with_month, with_week
from pulseframe.operators.weekly import distinct_values
from workload import monthly, tables, weekly


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(text, node):
    """The part of a plan's text under the first line that holds ``node``."""
    lines = text.split("\n")
    depth = lambda line: re.match(r"[\s:|+-]*", line).end()
    at = next(i for i, line in enumerate(lines) if node in line)
    stop = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:stop])


def test_lines_are_not_shuffled_for_customers(spark, sf_dir):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tables.raw_purchases(spark, sf_dir, by_date=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for key in ("o_custkey", "c_nationkey"):
        assert "l_orderkey" not in below(text, f"Exchange hashpartitioning({key}")
    laid = below(text, "Exchange hashpartitioning(trunc").split("\n")[1]
    assert "spread" in laid and not re.search("l_linenumber#[0-9]+, |l_suppkey#[0-9]+, ", laid.split("AS")[-1])


@pytest.mark.parametrize("identity", ["values", "digest"])
def test_daily_copies_add_up_to_weeks_and_months(spark, identity):
    days = [date(2020, 1, 30), date(2020, 1, 31), date(2020, 2, 1), date(2020, 2, 3), None]
    rows = [(d, name) for d in days for name in ("a", "a", "b", None, None, "x" * 70, "x" * 70)] + [(days[0], "c")]
    df = spark.createDataFrame(rows, "d date, name string")
    daily = duplicates.daily_copies(df, "d", identity)
    assert {r["day"]: (r["total_records"], r["unique_records"]) for r in daily.collect()} == {
        days[0]: (8, 5), days[1]: (7, 4), days[2]: (7, 4), days[3]: (7, 4)}
    for span, dated in ((month_key, with_month(df, "d", "k")), (week_start, with_week(df, "d", "k"))):
        found = duplicates.duplicates_of_spans(daily, span(F.col("day")), "k")
        wanted = duplicates.duplicate_rows(dated, ["k"], identity)
        assert found.dtypes == wanted.dtypes
        assert sorted(found.collect()) == sorted(wanted.collect())


def test_weeks_and_months_share_one_shuffle_of_the_rows(spark, sf_dir):
    for df in (weekly.scores(spark, sf_dir), weekly.features(spark, sf_dir), monthly.month_health(spark, sf_dir)):
        assert "__row0" not in plan(df)


def test_exports_evaluate_the_purchases_once(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "_staged", {})
    calls, build = [], tables.raw_purchases
    monkeypatch.setattr(tables, "raw_purchases", lambda *a, **b: calls.append(a) or build(*a, **b))
    if hasattr(weekly, "raw_purchases"):
        monkeypatch.setattr(weekly, "raw_purchases", tables.raw_purchases)
    written, export, contents = [], weekly.csv_export, []

    def kept(df):
        contents.append(df)
        written.append(export(df))
        return written[-1]

    monkeypatch.setattr(weekly, "csv_export", kept)
    contract.queries()["csv_rejections"](spark, sf_dir)
    assert len(written) == 3
    assert all("Join" not in plan(df) for df in contents)  # each export reads the written table
    assert len(calls) == 1


def test_exports_are_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(weekly, "CSV_ROWS_PER_FILE", 100)
    rows = spark.range(1000, numPartitions=1).select("id", F.lit('a "quoted", text ').alias("title"))
    path = weekly.csv_export(rows)
    files = [f for f in glob.glob(os.path.join(path, "part-*"))]
    assert len(files) == 10 and all(not f.endswith(".csv") for f in files)
    back = weekly.files.read_typed_csv(spark, path, rows.schema, multi_line=False)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_bitmaps_are_built_once_where_their_codes_meet(spark):
    daily = spark.range(4000).select(
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 2).cast("int")).alias("day"),
        (F.col("id") % 4).cast("string").alias("column"), F.col("id").cast("string").alias("value"))
    codes = daily.select("column", "value").withColumn("code", F.monotonically_increasing_id())
    state = distinct_state.bitmap_state(daily, codes)
    text = plan(state)
    # Codes are shuffled by their bitmap; no aggregation lies below that shuffle, so no partial bitmap is moved.
    assert "bitmap_construct_agg" not in below(text, "Exchange hashpartitioning(day")
    counts = distinct_state.distinct_counts(state, F.trunc("day", "year"))
    assert sorted(map(tuple, counts.collect())) == [(date(2020, 1, 1), str(n), 1000) for n in range(4)]


def test_a_task_holds_the_values_of_one_column(spark, sf_dir):
    # Several distinct counts in one aggregation are planned as an Expand: entries of all columns in every task.
    assert "Expand" not in plan(weekly.features(spark, sf_dir))


def test_distinct_values_of_nulls_zeros_and_copies(spark):
    weeks = [date(2020, 1, 6), date(2020, 1, 13), None]
    rows = [(w, e, p, None, w and "x") for w in weeks for e, p in (
        (1, 0.0), (1, -0.0), (None, float("nan")), (2, float("nan")), (2, None), (2, None), (3, 1.0))] + [(weeks[0], 9, 7.0, None, "y")]
    df = spark.createDataFrame(rows, "week_start date, entity int, price double, gone string, state string")
    counted = {"a": "entity", "b": "price", "c": "gone", "d": "state", "e": "entity"}
    found = distinct_values(df, counted)
    wanted = df.groupBy("week_start").agg(*[F.count_distinct(c).alias(n) for n, c in counted.items()])
    assert found.dtypes == wanted.dtypes
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)
    assert {r["week_start"]: tuple(r)[1:] for r in found.collect()}[weeks[0]] == (4, 4, 0, 2, 4)
