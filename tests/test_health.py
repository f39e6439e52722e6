"""Batch health, single batches, schema drift and the dataset report on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import Row, functions as F

from pulseframe.operators import health, schema
from pulseframe.operators.cleaning import with_month
from pulseframe.plans import batch_health as bh
from pulseframe.plans.dataset_report import dataset_outliers, dataset_report
from pulseframe.rules import DatasetRules, HealthRules
from pulseframe.sources.files import read_any_csv

BATCH = (
    "batch string, total_records bigint, missing array<struct<column:string,missing_percentage:double>>, "
    "outliers array<struct<column:string,outlier_percentage:double>>, duplicate_percentage double, "
    "previous_records bigint, growth_rate double, schema_drift struct<detected:boolean>"
)


def judged(spark, missing=0.0, duplicates=0.0, growth=0.0, outliers=0.0, drift=False, previous=100):
    row = ("m", 100, [("a", missing)], [("q", outliers)], duplicates, previous, growth, (drift,))
    return health.with_batch_score(spark.createDataFrame([row], BATCH), HealthRules()).first()


@pytest.mark.parametrize("values, score", [
    ({}, 100), ({"missing": 20.0}, 100), ({"missing": 20.01}, 85), ({"duplicates": 3.0}, 100),
    ({"duplicates": 3.01}, 85), ({"growth": 50.0}, 100), ({"growth": 50.01}, 80), ({"growth": -50.01}, 80),
    ({"growth": 99.0, "previous": None}, 100), ({"outliers": 3.0}, 100), ({"outliers": 3.01}, 85),
    ({"drift": True}, 75),
    ({"missing": 30.0, "duplicates": 9.0, "growth": 80.0, "outliers": 9.0, "drift": True}, 10),
])
def test_deduction_limits(spark, values, score):
    assert judged(spark, **values)["health_score"] == score


@pytest.mark.parametrize("score, status", [(90, "Healthy"), (85, "Warning"), (70, "Warning"), (69, "Critical")])
def test_batch_status(spark, score, status):
    row = spark.createDataFrame([(score,)], "s int").select(health.batch_status(F.col("s"), HealthRules()).alias("x"))
    assert row.first()["x"] == status


def test_texts_in_order(spark):
    row = judged(spark, missing=30.0, duplicates=9.125, growth=-80.0, outliers=9.0, drift=True)
    assert row["data_quality_anomalies"] == [
        "High missing values in a: 30.00%", "High duplicate percentage: 9.13%", "Abnormal batch-size change: -80.00%",
        "High numerical outlier percentage in q: 9.00%", "Schema drift detected.",
    ]
    assert row["deductions"] == [
        "High missing values: -15", "High duplicate percentage: -15", "Abnormal batch-size change: -20",
        "High numerical outliers: -15", "Schema drift: -25",
    ]
    assert row["health_status"] == "Critical"


SF_DIR = "/root/testdata/sf0.001"
ORDERS = "d date, q double, r string"


def orders(spark, months):
    """``months`` maps a month number to the quantities sold in it."""
    rows = [(date(2024, m, 1 + i % 28), None if q is None else float(q), f"r{i}") for m, qs in months.items() for i, q in enumerate(qs)]
    return with_month(spark.createDataFrame(rows, ORDERS), "d")


def test_batch_health_over_months(spark):
    df = orders(spark, {1: [1, 2, 3, 4, 100], 2: [1, 2, 3, 4, None] * 2, 3: [5]})
    jan, feb, mar = bh.batch_health(df, ["q"], monthly=True).orderBy("batch").collect()
    assert [r["growth_rate"] for r in (jan, feb, mar)] == [0.0, 100.0, -90.0]
    assert jan["schema_drift"]["baseline"] and not feb["schema_drift"]["baseline"]
    fence = jan["outliers"][0]
    assert (fence["q1"], fence["q3"], fence["outlier_count"], fence["outlier_percentage"]) == (2.0, 4.0, 1, 20.0)
    assert feb["numeric"][0]["count"] == 10 and feb["outliers"][0]["valid_count"] == 8
    assert mar["numeric"][0]["stddev"] is None
    assert feb["missing"][1]["missing_percentage"] == 20.0 and feb["total_missing"] == 2


def test_a_daily_key_stays_a_day(spark):
    df = orders(spark, {1: [1, 2, 3]}).drop("batch")
    rows = bh.batch_health(df, ["q"], "d").orderBy("d").collect()
    assert [r["d"] for r in rows] == [date(2024, 1, n) for n in (1, 2, 3)]
    assert [r["previous_records"] for r in rows] == [None, 1, 1]


def test_a_year_without_a_release_takes_the_latest_before_it(spark):
    from workload import monthly

    years = spark.createDataFrame([(y,) for y in (1990, 1998, 2001, 2007)], "y int")
    got = {r["y"]: r["r"] for r in years.select("y", monthly.release_of(F.col("y")).alias("r")).collect()}
    assert got == {1990: 1995, 1998: 1998, 2001: 2001, 2007: 2001}
    batches = spark.createDataFrame([("1990",), ("2007",)], "batch string")
    found = monthly.release_schemas(spark, SF_DIR, batches).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in found} == {"1990": 5, "2007": 6}


def test_batch_with_an_all_null_column_gives_nulls(spark):
    row = bh.batch_health(orders(spark, {1: [None, None]}), ["q"], monthly=True).first()
    assert row["numeric"][0]["mean"] is None and row["outliers"][0]["q1"] is None
    assert row["outliers"][0]["outlier_count"] == 0
    assert "High missing values in q: 100.00%" in row["data_quality_anomalies"]


def test_single_batch_counts_valid_values_and_sees_schema_drift(spark):
    df = orders(spark, {1: [1, 2, 3, 4, None, None]})
    row = bh.single_batch_health(
        df, "2024-01", ["q", "price"], previous_records=3,
        previous_schema={"d": "date", "q": "int", "gone": "string"},
    ).first()
    assert row["numeric"] == [Row(column="q", count=4, mean=2.5, stddev=pytest.approx(1.2909944), min=1.0, max=4.0)]
    assert row["growth_rate"] == 100.0
    drift = row["schema_drift"]
    assert (drift["added_columns"], drift["removed_columns"]) == (["r"], ["gone"])
    assert drift["changed_data_types"] == [Row(column="q", previous_type="int", current_type="double")]
    assert row["health_score"] == 100 - 15 - 20 - 25


def test_single_batch_without_history(spark):
    row = bh.single_batch_health(orders(spark, {1: [1, 2]}), "2024-01", ["q"]).first()
    assert row["growth_rate"] == 0.0 and row["schema_drift"]["baseline"] and row["health_score"] == 100


def test_health_documents_hold_every_field(spark):
    df = orders(spark, {1: [1, 2, 3, 4, 100]})
    doc = bh.health_documents(bh.batch_health(df, ["q"], monthly=True), schema.schema_snapshot(df, ["batch"])).first()
    assert doc["schema"] == {"d": "date", "q": "double", "r": "string"}
    assert doc["missing_values_per_column"] == {"d": 0, "q": 0, "r": 0}
    assert doc["outlier_analysis"]["q"]["upper_bound"] == 7.0
    assert doc["severity"] == doc["health_status"]
    assert len(doc) == 19


def test_schema_drift_between_named_batches(spark):
    history = schema.schema_history(spark, {
        "2024-01": {"a": "int", "b": "string"}, "2024-02": {"a": "int", "b": "string", "c": "date"},
        "2024-03": {"a": "bigint", "c": "date"}, "2024-04": {"a": "bigint", "c": "date"},
    })
    first, second, third, fourth = schema.schema_drift(history).orderBy("batch").collect()
    assert first["baseline"] and not first["detected"] and first["added_columns"] == []
    assert second["added_columns"] == ["c"] and second["detected"]
    assert third["removed_columns"] == ["b"]
    assert third["changed_data_types"] == [Row(column="a", previous_type="int", current_type="bigint")]
    assert not fourth["detected"] and not fourth["baseline"]


def test_batch_health_with_schema_changes_per_batch(spark):
    df = orders(spark, {1: [1, 2, 3, 4], 2: [1, 2, 3, 4]})
    changes = schema.schema_drift(schema.schema_history(spark, {"2024-01": {"a": "int"}, "2024-02": {"b": "int"}}))
    jan, feb = bh.batch_health(df, ["q"], schema_changes=changes, monthly=True).orderBy("batch").collect()
    assert (jan["health_score"], feb["health_score"]) == (100, 75)


def test_date_column_prefers_types_to_names(spark):
    named = spark.createDataFrame([("x", 1)], "update_text string, n int")
    typed = spark.createDataFrame([("x", None)], "update_text string, n date")
    naive = spark.createDataFrame([("x", None)], "update_text string, n timestamp_ntz")
    assert schema.date_column(named) == "update_text"
    assert schema.date_column(typed) == schema.date_column(naive) == "n"
    assert schema.date_column(spark.createDataFrame([(1,)], "n int")) is None


FAULTY = """ticket,person,area,amount,pieces,sold_on
1,Ana,N,120.5,3,2024-01-05
2,Ben,W,98.0,2,2024-01-06
3,Cleo,S,,5,2024-01-07
4,Dan,E,140.0,,2024-01-08
5,Eve,N,110.0,4,
6,Finn,W,105.0,3,2024-01-10
7,Gus,S,9000.0,1,2024-01-11
2,Ben,W,98.0,2,2024-01-06
9,"  ",E,130.0,4,2024-01-13
10,Ivy,N,115.0,3,2024-01-14
"""


def write(tmp_path, text):
    path = tmp_path / "sample.csv"
    path.write_text(text)
    return str(path)


def test_report_of_a_faulty_csv(spark, tmp_path):
    row = dataset_report(read_any_csv(spark, write(tmp_path, FAULTY)), "sample.csv").first()
    assert (row["row_count"], row["column_count"], row["total_missing_values"]) == (10, 6, 4)
    assert row["overall_missing_percentage"] == 6.67
    assert (row["duplicate_row_count"], row["duplicate_percentage"]) == (1, 10.0)
    assert [o["column"] for o in row["outlier_analysis"]] == ["ticket", "amount", "pieces"]
    assert [o["outlier_count"] for o in row["outlier_analysis"]] == [0, 1, 0]
    assert row["overall_outlier_percentage"] == 3.57
    assert (row["data_health_score"], row["health_status"]) == (55, "WARNING")
    assert row["detected_issues"] == [
        "High missing-value rate detected: 6.7%", "Duplicate rows detected: 10.0%",
        "Outliers detected across numeric fields: 3.6%",
    ]
    assert row["date_detection_message"].endswith("Candidate date/time column: sold_on.")
    assert row["numerical_summary"][1]["count"] == 9


def test_report_of_clean_text(spark, tmp_path):
    text = "code,team,city\nA1,Ops,Oslo\nA2,Dev,Rome\nA3,Dev,Bern\n"
    row = dataset_report(read_any_csv(spark, write(tmp_path, text)), "t.csv").first()
    assert (row["data_health_score"], row["health_status"]) == (100, "HEALTHY")
    assert row["detected_issues"] == ["No major data-health issues detected."]
    assert row["numerical_summary"] == [] and row["outlier_analysis"] == []
    assert row["date_detection_message"] is None


def test_report_of_a_header_without_rows(spark, tmp_path):
    row = dataset_report(read_any_csv(spark, write(tmp_path, "a,b\n")), "empty.csv").first()
    assert (row["row_count"], row["data_health_score"], row["health_status"]) == (0, 90, "HEALTHY")
    assert row["detected_issues"] == ["Dataset usability is limited: readable columns or valid rows are missing."]
    assert not row["has_valid_rows"] and row["has_readable_columns"]


def test_outlier_analysis_skips_short_and_flat_columns(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1.0), (2, 5.0, None), (3, 5.0, None), (4, 5.0, 2.0), (90, 5.0, 3.0)], "a int, flat double, short double")
    assert [r["column"] for r in dataset_outliers(df).collect()] == ["a"]


@pytest.mark.parametrize("missing, duplicates, outliers, usable, score, status", [
    (1.0, 1.0, 2.0, True, 100, "HEALTHY"), (1.01, 0.0, 0.0, True, 90, "HEALTHY"), (5.0, 5.0, 5.0, True, 75, "WARNING"),
    (5.01, 5.01, 5.01, True, 50, "WARNING"), (15.01, 15.01, 10.01, True, 20, "CRITICAL"),
    (15.01, 15.01, 10.01, False, 10, "CRITICAL"), (0.0, 0.0, 0.0, False, 90, "HEALTHY"),
])
def test_dataset_score_tiers(spark, missing, duplicates, outliers, usable, score, status):
    limits = DatasetRules()
    row = spark.createDataFrame([(missing, duplicates, outliers, usable)], "m double, d double, o double, u boolean")
    scored = row.select(health.dataset_score(*[F.col(n) for n in "mdou"], limits).alias("score"))
    found = scored.select("score", health.dataset_status(F.col("score"), limits).alias("status")).first()
    assert (found["score"], found["status"]) == (score, status)


def test_growth_in_ranges_equals_growth_in_one_window(spark):
    """A million batches, a NULL batch and NULL record counts."""
    rows = spark.range(1_000_000).select(
        F.when(F.col("id") != 500, F.col("id") * 7 % 1_000_003).alias("batch"),
        F.when(F.col("id") % 1000 != 3, F.col("id") % 97 + 1).alias("total_records"))
    ranged, plain = health.with_growth_in_ranges(rows.repartition(5)), health.with_growth(rows)
    assert ranged.columns == plain.columns
    assert ranged.count() == 1_000_000
    assert ranged.exceptAll(plain).isEmpty()


def test_growth_in_ranges_of_few_or_no_batches(spark):
    rows = spark.createDataFrame([("b", 10), ("a", 5), (None, 4)], "batch string, total_records long")
    found = [(r["batch"], r["previous_records"], r["growth_rate"]) for r in health.with_growth_in_ranges(rows).orderBy("batch").collect()]
    assert found == [(None, None, 0.0), ("a", 4, 25.0), ("b", 5, 100.0)]
    assert health.with_growth_in_ranges(rows.limit(0)).count() == 0
