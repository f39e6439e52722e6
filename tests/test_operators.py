"""Cleaning, missing values, duplicates, numeric operators, sources and staging."""

import hashlib
import math
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Row, functions as F, types as T

from pulseframe.functions import percent
from pulseframe.operators import cleaning, duplicates, missing, numeric, schema
from pulseframe.plans import views
from pulseframe.plans.prepare import prepare_purchases, prepare_to_parquet
from pulseframe.sources import files, staging


def test_date_ranges_keep_all_rows_and_split_a_hot_date(spark):
    df = spark.range(3000, numPartitions=4).select(
        "id", F.date_add(F.lit(date(2024, 1, 1)), F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 90).cast("int"))).alias("d"))
    laid = cleaning.in_date_ranges(df, "d", ["id"]).withColumn("part", F.spark_partition_id())
    assert laid.count() == 3000 and laid.select("id").distinct().count() == 3000
    spans = laid.groupBy("part").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n"))
    rows = sorted(spans.collect(), key=lambda r: (r["low"], r["high"]))
    assert all(a["high"] <= b["low"] for a, b in zip(rows, rows[1:]))


def test_blank_strings_become_null_and_the_rest_is_untouched(spark):
    df = spark.createDataFrame([("", " x ", ""), ("   ", "\t", "  "), (None, "y", "z")], "a string, b string, keep string")
    rows = cleaning.blank_to_null(df, ["a", "b"]).collect()
    assert rows == [Row(a=None, b=" x ", keep=""), Row(a=None, b="\t", keep="  "), Row(a=None, b="y", keep="z")]


def test_validation_counts_bad_dates_and_the_year(spark):
    df = spark.createDataFrame([(date(2022, 5, 1),), (date(2022, 1, 1),), (date(2021, 12, 31),), (None,)], "d date")
    row = cleaning.validation_summary(df, "d", 2022).first()
    assert row == Row(invalid_dates=1, records=2, earliest_date=date(2022, 1, 1), latest_date=date(2022, 5, 1))
    with pytest.raises(ValueError, match="Found 1 null or unparseable d values"):
        cleaning.check_dates(cleaning.validation_summary(df, "d", 2022), "d", "2022")
    with pytest.raises(ValueError, match="No 2030 records"):
        cleaning.check_dates(cleaning.validation_summary(df.na.drop(), "d", 2030), "d", "2030")


def test_batch_keys(spark):
    df = spark.createDataFrame([(date(2022, 1, 1),), (None,)], "d date")
    months = cleaning.with_month(spark.createDataFrame([(date(2022, 2, 27),), (None,)], "d date"), "d")
    assert months.collect() == [Row(d=date(2022, 2, 27), batch=date(2022, 2, 1))]
    assert cleaning.with_month_label(months).first()["batch"] == "2022-02"
    moments = spark.createDataFrame([(datetime(2022, 2, 27, 23, 59),)], "d timestamp")
    assert cleaning.with_week(moments, "d").first()["week_start"] == date(2022, 2, 21)
    assert cleaning.with_week(df, "d").first()["week_start"] == date(2021, 12, 27)


def test_missing_counts_by_batch_with_odd_names(spark):
    df = spark.createDataFrame([("m", None, " "), ("m", 1, "x"), ("n", None, None)], "k string, `a.b` int, `c/d (e)` string")
    strict = missing.column_missing(df, ["k"]).orderBy("k", "column").collect()
    assert [(r["column"], r["missing_count"], r["missing_percentage"]) for r in strict] == [
        ("a.b", 1, 50.0), ("c/d (e)", 0, 0.0), ("a.b", 1, 100.0), ("c/d (e)", 1, 100.0)]
    blank = missing.missing_summary(df.drop("k"), blank_is_missing=True, digits=2).first()
    assert (blank["total_missing"], blank["missing_percentage"]) == (4, 66.67)


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(percent(F.lit(0), F.lit(0), 4).alias("a"), percent(F.lit(1), F.lit(3), 4).alias("b")).first()
    assert (row["a"], row["b"]) == (0.0, 33.3333)


TRICKY = [
    ("a", "b", 0.0, None), ("a", "b", -0.0, None), ("ab", "", 0.0, None), ("", "ab", 0.0, None), (None, "ab", 0.0, None),
    ("ab", None, 0.0, None), ("n", None, None, 1), (None, "n", None, 1), ("1:a", "b", None, 1), ("1", "a1:b", None, 1),
    ("x", "y", math.nan, 2), ("x", "y", math.nan, 2), (None, None, None, None),
]
ROW = "a string, b string, c double, d int"


def test_digest_tells_rows_apart_like_grouping_does(spark):
    df = spark.createDataFrame(TRICKY, ROW)
    by_value, by_digest = (duplicates.duplicate_rows(df, identity=i).first() for i in ("values", "digest"))
    assert by_value == by_digest
    assert by_value["unique_records"] == df.dropDuplicates().count() == len(TRICKY) - 2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["m", "n"]), st.one_of(st.none(), st.text(alphabet="a:1n ", max_size=3)),
    st.one_of(st.none(), st.text(alphabet="a:1n ", max_size=3)), st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5])),
), min_size=1, max_size=30))
def test_duplicates_agree_with_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, a string, b string, c double")
    expected = {}
    for key, *rest in rows:
        expected.setdefault(key, []).append(tuple(rest))
    for identity in ("values", "digest"):
        found = {r["k"]: r for r in duplicates.duplicate_rows(df, ["k"], identity).collect()}
        assert {k: r["duplicate_records"] for k, r in found.items()} == {
            k: len(v) - len(set(v)) for k, v in expected.items()}


def test_duplicates_of_nested_rows_and_of_nothing(spark):
    nested = spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["a, b"],)], "x array<string>")
    assert duplicates.duplicate_rows(nested, identity="digest").first()["duplicate_records"] == 1
    empty = duplicates.duplicate_rows(nested.limit(0)).first()
    assert (empty["total_records"], empty["duplicate_records"], empty["duplicate_percentage"]) == (0, 0, 0.0)


def test_long_texts_timestamps_and_binary_in_digests(spark):
    long = "x" * 64
    texts = spark.createDataFrame([(long,), (long,), (long + "y",), (hashlib.sha256(long.encode()).hexdigest()[:63],)], "s string")
    assert duplicates.duplicate_rows(texts, identity="digest").first()["unique_records"] == 3
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 1), b"\x00"), (datetime(2024, 1, 1, 0, 0, 0, 2), b"\x00"),
            (datetime(2024, 1, 1, 0, 0, 0, 1), b"\xff"), (datetime(2024, 1, 1, 0, 0, 0, 1), b"\xfe")]
    df = spark.createDataFrame(rows, "t timestamp, b binary")
    assert duplicates.duplicate_rows(df, identity="digest").first()["unique_records"] == 4


def test_outliers_with_salt_equal_outliers_with_broadcast(spark):
    # One batch holds most rows, and most of those are copies of one value.
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 3 > 0, 5.0).when(F.col("id") % 50 == 0, None).otherwise((F.col("id") % 97).cast("double")).alias("v"),
    )
    one = numeric.iqr_outliers(df, ["v"], ["k"], max_groups=8).orderBy("k").collect()
    counted = numeric.iqr_outliers(df, ["v"], ["k"]).orderBy("k").collect()
    salted = numeric.iqr_outliers(df, ["v"], ["k"], broadcast_bytes=0).orderBy("k").collect()
    assert one == counted == salted and len(one) == 8
    brute = df.toPandas()
    for row in one:
        values = sorted(brute[(brute.k == row["k"]) & brute.v.notna()].v)
        q1, q3 = (values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.75))
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (row["q1"], row["q3"], row["valid_count"]) == (q1, q3, len(values))
        assert row["outlier_count"] == sum(v < low or v > high for v in values)


def test_large_quartiles_stay_within_the_sketch_bound(spark):
    n = 200_000
    df = spark.range(n, numPartitions=8).select(F.col("id").cast("double").alias("v"))
    row = numeric.quartiles(df, ["v"], accuracy=10000).first()
    assert abs(row["q1"] - n * 0.25) <= n / 10000 + 1 and abs(row["q3"] - n * 0.75) <= n / 10000 + 1


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("accuracy", [20, 1000])
def test_large_quantiles_are_exact(spark, by, accuracy):
    """Over two million values in one group, far more than a sketch holds: ties, NULLs, a NULL group, a column of NULLs."""
    n = 2_400_000
    skewed = F.when(F.col("id") % 50 != 0, F.exp((F.xxhash64("id") % 1000003) / 100000.0))
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 20 > 0, "hot").alias("k"), skewed.alias("v"), (F.col("id") % 7).cast("double").alias("w"),
        F.lit(None).cast("double").alias("x"),
    )
    brute = df.toPandas()
    groups = {"hot": brute[brute.k == "hot"], None: brute[brute.k.isna()]} if by else {"all": brute}
    rows = numeric.quantiles(df, ["v", "w", "x"], (0.25, 0.5, 0.75), by, accuracy=accuracy).collect()
    assert len(rows) == len(groups)
    for row in rows:
        group = groups[row["k"] if by else "all"]
        assert row["rows"] == len(group)
        for i, name in enumerate("vw"):
            values = group[name].dropna().sort_values().to_numpy()
            exact = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
            assert [row[f"q__{i}_{j}"] for j in range(3)] == exact
        assert [row[f"q__2_{j}"] for j in range(3)] == [None] * 3


def test_quantiles_of_odd_values(spark):
    values = [float("inf"), float("-inf"), 1e308, -1e308, 0.0, -0.0, 5e-324, None, 1.0, 1.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = numeric.quantiles(df, ["v"], (0.1, 0.25, 0.5, 0.75, 1.0)).first()
    known = sorted(v for v in values if v is not None)
    assert [row[f"q__0_{j}"] for j in range(5)] == [known[math.ceil(p * len(known)) - 1] for p in (0.1, 0.25, 0.5, 0.75, 1.0)]
    empty = numeric.quantiles(df.limit(0), ["v"], (0.5,)).collect()
    assert [tuple(r) for r in empty] == [(0, None)]
    assert numeric.quantiles(df.limit(0).withColumn("k", F.lit(1)), ["v"], (0.5,), ["k"]).collect() == []


def test_numeric_types(spark):
    df = spark.createDataFrame([], "a tinyint, b smallint, c int, d bigint, e float, f double, g decimal(5,2), h string, i date")
    assert numeric.numeric_columns(df) == list("abcdefg")


CSV = (
    "Order Date,Purchase Price Per Unit,Quantity,Shipping Address State,Title,ASIN/ISBN (Product Code),Category,"
    "Survey ResponseID\n"
    '2022-03-01,10.5,1.0,NJ,"A ""big"", wide\nbox",B1,  ,R1\n'
    "2021-12-31,1.0,2.0,,Pen,B2,Pens,R2\n"
)


def test_prepare_reads_cleans_and_writes(spark, tmp_path):
    source, target = tmp_path / "p.csv", str(tmp_path / "out")
    source.write_text(CSV)
    rows = prepare_to_parquet(spark, str(source), target, 2022).collect()
    assert len(rows) == 1
    assert rows[0]["Title"] == 'A "big", wide\nbox' and rows[0]["Category"] is None
    assert rows[0]["Order Date"] == date(2022, 3, 1)
    laid = prepare_to_parquet(spark, str(source), str(tmp_path / "laid"), 2022, spread=["Survey ResponseID"])
    assert laid.collect() == rows
    with pytest.raises(ValueError, match="No genuine 1999"):
        prepare_to_parquet(spark, str(source), target, 1999)


def test_prepare_rejects_bad_dates(spark, tmp_path):
    source = tmp_path / "p.csv"
    source.write_text(CSV + "not a date,1.0,2.0,,Pen,B2,Pens,R2\n")
    with pytest.raises(ValueError, match="Found 1 null or unparseable Order Date values"):
        prepare_to_parquet(spark, str(source), str(tmp_path / "out"), 2022)


def test_typed_csv_rejects_other_columns(spark, tmp_path):
    source = tmp_path / "p.csv"
    source.write_text(CSV.replace("Quantity,Shipping Address State", "Shipping Address State,Quantity"))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_typed_csv(spark, str(source)).collect()


def test_any_csv_messages(spark, tmp_path):
    with pytest.raises(files.CsvReadError, match="Please upload a valid .csv file."):
        files.read_any_csv(spark, str(tmp_path / "a.txt"))
    with pytest.raises(files.CsvReadError, match="Unable to read the CSV file"):
        files.read_any_csv(spark, str(tmp_path / "absent.csv"))


def test_json_array_source(spark, tmp_path):
    path = tmp_path / "h.json"
    path.write_text('[\n {"alert_id": "x", "n": 1},\n {"alert_id": "y", "n": null}\n]')
    rows = files.read_json(spark, str(path), "alert_id string, n int", as_array=True).collect()
    assert rows == [Row(alert_id="x", n=1), Row(alert_id="y", n=None)]


def test_json_sink_keeps_null_fields(spark, tmp_path):
    files.write_json(spark.createDataFrame([("a", None)], "x string, y int"), str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).first()[0] == '{"x":"a","y":null}'


def test_table_facts_and_preview(spark):
    df = spark.range(9).withColumn("b", F.lit("x"))
    row = files.table_facts(df).first()
    assert (row["row_count"], row["column_count"], row["columns"]) == (9, 2, ["id", "b"])
    assert files.preview(df).count() == 5


def test_stage_writes_under_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "numbers")
    assert staged.count() == 3
    root = staging.shared_root(spark)
    assert root == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert all(root in f for f in staged.inputFiles())


def test_schema_overview(spark):
    rows = schema.schema_overview(spark.createDataFrame([], "a int, `b c` array<string>")).collect()
    assert [(r["column_name"], r["data_type"]) for r in rows] == [("a", "int"), ("b c", "array<string>")]


def test_views_of_one_month_and_one_week(spark, sf_dir):
    from workload import monthly, weekly

    health = monthly.month_health(spark, sf_dir)
    assert views.month_missing(health, "1998-03").count() == len(monthly.COLUMNS)
    assert views.month_numeric(health, "1998-03").count() == views.month_outliers(health, "1998-03").count() == 2
    assert views.week_comparison(weekly.comparison(spark, sf_dir), "1998-09-07").count() == 11
    top = views.labelled_deviations(weekly.scores(spark, sf_dir), "1998-09-07").orderBy("rank").collect()
    assert [r["rank"] for r in top] == [1, 2, 3]


def test_prepare_keeps_types(spark):
    schema_in = T.StructType([T.StructField("Order Date", T.DateType()), T.StructField("Title", T.StringType())])
    df = spark.createDataFrame([(date(2022, 1, 1), " ")], schema_in)
    assert prepare_purchases(df, 2022).schema == schema_in
