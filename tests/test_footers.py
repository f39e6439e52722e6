"""Counts and date ranges out of file footers."""

from datetime import date

from pyspark.sql import functions as F

from pulseframe.sources import footers


def test_no_row_group_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.date_add(F.lit(date(2022, 1, 1)), (F.col("id") % 90).cast("int")).alias("day"), "id")
    rows.repartition(3).write.parquet(path)
    text = footers.footer_aggregates(spark, path, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(day), MAX(day)]" in text
    expected = (1000, date(2022, 1, 1), date(2022, 3, 31))
    assert tuple(footers.footer_facts(spark, path, "day").first()) == expected
    # The session that asked keeps its settings.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_files_without_statistics_are_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "t").mkdir()
    days = pa.table({"day": pa.array([date(2022, 5, 1), None, date(2022, 4, 1)], pa.date32())})
    pq.write_table(days, tmp_path / "t" / "part-0.parquet", write_statistics=False)
    found = footers.footer_facts(spark, str(tmp_path / "t"), "day").first()
    assert tuple(found) == (3, date(2022, 4, 1), date(2022, 5, 1))


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([], "day date").write.parquet(path)
    assert tuple(footers.footer_facts(spark, path, "day").first()) == (0, None, None)
