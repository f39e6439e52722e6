"""Distinct counts from stored daily state."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import distinct_state as ds
from workload import weekly


@pytest.fixture(scope="module")
def rows(spark):
    first = date(2022, 1, 3)
    data = [
        (first + timedelta(days=n % 60) if n % 97 else None, "hot" if n % 3 else f"v{n}", n % 500 if n % 7 else None)
        for n in range(9000)
    ]
    return spark.createDataFrame(data, "d date, a string, b int").repartition(5)


def brute(rows, span):
    found = {}
    for d, a, b in rows.collect():
        for name, value in (("a", a), ("b", b)):
            if d is not None and value is not None:
                found.setdefault((span(d), name), set()).add(value)
    return {k: len(v) for k, v in found.items()}


def counts(df):
    return {(r["span"], r["column"]): r["distinct_values"] for r in df.collect()}


def written(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_any_span_from_one_state(rows, tmp_path):
    daily = written(ds.daily_values(rows, "d", ["a", "b"]), str(tmp_path / "daily"))
    state = ds.bitmap_state(daily, written(ds.dictionary(daily), str(tmp_path / "codes")))
    state = written(state, str(tmp_path / "state"))
    monday = lambda d: d - timedelta(days=d.weekday())
    assert counts(ds.distinct_counts(state, F.trunc("day", "week"))) == brute(rows, monday)
    assert counts(ds.distinct_counts(state, F.trunc("day", "month"))) == brute(rows, lambda d: d.replace(day=1))
    assert counts(ds.distinct_counts(state, F.lit("all"))) == brute(rows, lambda d: "all")
    plan = ds.distinct_counts(state, F.trunc("day", "week"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and str(tmp_path / "state") in plan and "daily" not in plan


def test_codes_stay_when_values_are_added(rows, tmp_path):
    early, late = rows.where("d < '2022-02-01'"), rows.where("d >= '2022-02-01'")
    first = written(ds.daily_values(early, "d", ["a", "b"]), str(tmp_path / "first"))
    codes = written(ds.dictionary(first), str(tmp_path / "codes"))
    second = written(ds.daily_values(late, "d", ["a", "b"]), str(tmp_path / "second"))
    more = written(ds.dictionary(second, codes), str(tmp_path / "more"))
    assert codes.join(more, ["column", "value", "code"]).count() == codes.count()
    assert more.select("code").distinct().count() == more.count()
    state = ds.bitmap_state(first, codes).unionByName(ds.bitmap_state(second, more))
    assert counts(ds.distinct_counts(state, F.lit("all"))) == brute(rows, lambda d: "all")


def test_sketches_are_close(rows):
    found = counts(ds.approximate_counts(ds.sketch_state(rows, "d", ["a", "b"]), F.lit("all")))
    for key, exact in brute(rows, lambda d: "all").items():
        assert abs(found[key] - exact) <= 0.08 * exact


def test_nothing_gives_no_state(rows):
    daily = ds.daily_values(rows.limit(0), "d", ["a", "b"])
    assert ds.distinct_counts(ds.bitmap_state(daily, ds.dictionary(daily)), F.col("day")).collect() == []


def test_the_query_reads_only_the_state(spark, sf_dir):
    plan = weekly.distinct_spans(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "distinct-state" in plan and "purchases-" not in plan and "Expand" not in plan
