"""Queries over weekly behaviour, alerts, stores and file formats, each with its SQL."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pulseframe.operators import alerts, cleaning, distinct_state as ds, weekly
from pulseframe.operators.alerts import ALERT_SCHEMA
from pulseframe.operators.numeric import numeric_columns, numeric_stats
from pulseframe.operators.schema import schema_snapshot
from pulseframe.plans import batch_health as bh, views, weekly_drift as wd
from pulseframe.plans.alerting import build_alerts
from pulseframe.plans.csv_report import report_of_csv
from pulseframe.plans.incremental import batch_folders, refresh
from pulseframe.plans.prepare import prepare_to_parquet
from pulseframe.rules import FEATURE_LABELS, AlertRules
from pulseframe.sources import files, footers, report_store
from pulseframe.sources.alert_store import update_history
from pulseframe.sources.quarantine import read_with_quarantine
from pulseframe.sources.staging import fresh_path, stage
from workload import monthly as mo
from workload.tables import (
    DRIFT, PERIOD, ROLES, TABLES, daily_copies, purchases, staged_once, stored_raw, table,
)

FEATURES = list(FEATURE_LABELS)
GENERATED = "2024-01-01T00:00:00+00:00"
YEAR_1998 = AlertRules(active_year="1998")
CHOSEN_WEEK = "1998-09-07"
CSV_ROWS_PER_FILE = 1_000_000


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.weekly_features(purchases(spark, sf_dir), ROLES, daily=daily_copies(spark, sf_dir))


def in_two_steps(spark: SparkSession, rows: DataFrame, key: str, compute) -> DataFrame:
    """Results of ``compute`` kept up to date: a first refresh before the disturbed week, a second one after the rest
    came in, which computes the batches that are new or got more rows."""
    facts, store = fresh_path(spark, "facts"), fresh_path(spark, "results")
    spread = [ROLES.entity, ROLES.product]
    batch_folders(rows.where(F.col(ROLES.date) < CHOSEN_WEEK), facts, key, ROLES.date, spread)
    refresh(spark, facts, store, key, compute)
    late = rows.where(F.col(key) >= rows.where(F.col(ROLES.date) >= CHOSEN_WEEK).agg(F.min(key)).scalar())
    batch_folders(late, facts, key, ROLES.date, spread)
    return refresh(spark, facts, store, key, compute)


def incremental_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.with_week(purchases(spark, sf_dir), ROLES.date, weekly.WEEK)
    return in_two_steps(spark, rows, weekly.WEEK, lambda facts: weekly.weekly_features(facts, ROLES))


def incremental_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mo.monthly(spark, sf_dir)
    return in_two_steps(spark, rows, "batch", lambda facts: numeric_stats(facts, mo.NUMERIC, ["batch"]))


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with faults planted by product code, written as CSV and parsed once into good rows and rejected lines."""
    faulty = lambda column, number, text: F.when(F.col("product_code") % number == 0, text).otherwise(
        F.col(column).cast("string")).alias(column)
    rows = purchases(spark, sf_dir).select(
        faulty("order_date", 101, "someday"), faulty("quantity", 103, "many"), "product_code", "category")
    path = fresh_path(spark, "faulty")
    rows.write.option("header", True).csv(path)
    found = read_with_quarantine(
        spark, path, StructType.fromDDL("order_date date, quantity double, product_code bigint, category string"),
        multi_line=False)
    lines = found.rejected.groupBy(F.array_join("causes", ",").alias("causes")).agg(F.count(F.lit(1)).alias("line_count"))
    return lines.unionByName(found.good.agg(F.lit("").alias("causes"), F.count(F.lit(1)).alias("line_count")))


QUARANTINE_SQL = """SELECT concat_ws(',', CASE WHEN product_code % 101 = 0 THEN 'order_date' END,
  CASE WHEN product_code % 103 = 0 THEN 'quantity' END) AS causes, count(*) AS line_count FROM purchases GROUP BY 1"""


def footer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and date range of the written purchase table, from its footers."""
    folder = os.path.dirname(purchases(spark, sf_dir).inputFiles()[0])
    return footers.footer_facts(spark, folder, ROLES.date)


VARIETY = [ROLES.entity, ROLES.product, ROLES.category, ROLES.region]


def distinct_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bitmaps of the four identifying columns as a written table."""
    def build() -> DataFrame:
        daily = stage(ds.daily_values(purchases(spark, sf_dir), ROLES.date, VARIETY), "daily")
        return ds.bitmap_state(daily, stage(ds.dictionary(daily), "dictionary"))

    return staged_once(spark, sf_dir, "distinct-state", build)


def distinct_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per week, month and year, all from the daily state."""
    state, day = distinct_state(spark, sf_dir), F.col("day")
    spans = {"week": F.trunc(day, "week"), "month": F.trunc(day, "month"), "year": F.trunc(day, "year")}
    return mo.union_all([
        ds.distinct_counts(state, span).select(F.lit(name).alias("kind"), "span", "column", "distinct_values")
        for name, span in spans.items()
    ])


def distinct_spans_sql() -> str:
    return mo.with_purchases(" UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, CAST(date_trunc('{kind}', order_date) AS DATE) AS span, '{n}' AS "column",
        count(DISTINCT {n}) AS distinct_values FROM purchases WHERE {n} IS NOT NULL GROUP BY 2"""
        for kind in ("week", "month", "year") for n in VARIETY))


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.compare_to_history(features(spark, sf_dir), DRIFT)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.weekly_scores(purchases(spark, sf_dir), ROLES, DRIFT, daily=daily_copies(spark, sf_dir))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.weekly_fingerprints(scores(spark, sf_dir), DRIFT)


def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly scores as a written table, made once: what screens, documents and alerts read in place of facts."""
    return staged_once(spark, sf_dir, "weekly-scores", lambda: scores(spark, sf_dir))


def stored_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_once(spark, sf_dir, "weekly-comparison", lambda: comparison(spark, sf_dir))


def stored_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Weekly fingerprints and monthly health, from written tables."""
    return wd.weekly_fingerprints(stored_scores(spark, sf_dir), DRIFT), mo.stored_months(spark, sf_dir)


def every_alert(weeks: DataFrame, months: DataFrame) -> DataFrame:
    return build_alerts(weeks, months, GENERATED, batch="batch")


def flat_alerts(df: DataFrame) -> DataFrame:
    return df.select(
        "alert_id", "alert_type", "batch", "batch_timestamp", "severity", "similarity_score", "drift_status",
        "trigger", F.array_join(F.transform("top_deviating_features", lambda f: f["feature"]), ",").alias("features"),
        F.array_join("anomalies", "; ").alias("anomalies"), "source_window_note", "generated_timestamp",
    )


def earlier_history(weeks: DataFrame, months: DataFrame) -> DataFrame:
    """An alert history as an older release would have left it: other ids, a looser critical limit, and a
    warning for every month that is not critical."""
    older = alerts.behavior_alerts(weeks, GENERATED, replace(AlertRules(), critical_below=50.0))
    renamed = older.withColumn("alert_id", F.concat(F.lit("legacy-"), "alert_id"))
    warned = months.withColumn("health_status", F.when(F.col("health_status") == "Warning", "Critical"))
    lesser = alerts.health_alerts(warned, "2023-01-01T00:00:00+00:00").withColumn("severity", F.lit("WARNING"))
    return renamed.unionByName(lesser)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = stored_results(spark, sf_dir)
    return alerts.merge_history(alerts.active_history(earlier_history(*results), YEAR_1998), every_alert(*results))


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge through the history store: two runs over the same alerts leave one alert per batch."""
    path, results = fresh_path(spark, "alert-history"), stored_results(spark, sf_dir)
    update_history(earlier_history(*results), path, YEAR_1998)
    return update_history(every_alert(*results), path, YEAR_1998)


def week_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks, months = stored_results(spark, sf_dir)
    return alerts.week_status(weeks, every_alert(weeks, months))


# ---------------------------------------------------------------------------------------------- files and stores

def csv_export(df: DataFrame) -> str:
    """Write compressed CSV files with a header and blanks kept as they are. Such a file is one task when it is read, so
    its rows are bounded."""
    path = fresh_path(df.sparkSession, "purchases") + ".csv"
    df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("compression", "lz4").option(
        "maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(path)
    return path


def typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw purchases through CSV files in which every seventh product lost its dates."""
    raw = stored_raw(spark, sf_dir)
    spoiled = raw.withColumn("order_date", F.when(
        F.col("product_code") % 7 == 0, F.lit("unknown")).otherwise(F.date_format("order_date", "yyyy-MM-dd")))
    return files.read_typed_csv(spark, csv_export(spoiled), raw.schema, multi_line=False)


def prepared_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preparation: CSV export, typed scan, validation, cleaning, Parquet."""
    raw = stored_raw(spark, sf_dir)
    return prepare_to_parquet(
        spark, csv_export(raw), fresh_path(spark, "prepared"), 1998, ROLES.date, schema=raw.schema, multi_line=False)


def inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders") + ".csv"
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    loaded = files.read_any_csv(spark, path, multi_line=False)
    return mo.rounded(numeric_stats(loaded, numeric_columns(loaded), denominator="valid"))


def health_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly fingerprints written as JSON documents and read back with their schema."""
    path = fresh_path(spark, "fingerprints")
    facts = purchases(spark, sf_dir)
    documents = bh.health_documents(mo.stored_months(spark, sf_dir), schema_snapshot(facts))
    files.write_json(documents, path)
    loaded = files.read_json(spark, path, documents.schema)
    return mo.long_integers(loaded.select(
        F.col("month").alias("batch"), "total_records", "total_missing", "missing_percentage", "duplicate_records",
        "duplicate_percentage", "growth_rate", F.array_join("data_quality_anomalies", "; ").alias("anomalies"),
        F.array_join("deductions", "; ").alias("deductions"), "health_score", "health_status",
    ))


def missing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of missing counts inside the documents, back in long form."""
    documents = bh.health_documents(mo.stored_months(spark, sf_dir), schema_snapshot(purchases(spark, sf_dir)))
    return documents.select(
        F.col("month"), F.col("severity"), F.explode("missing_values_per_column").alias("column", "missing_count"))


def report_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports appended one by one, an hour apart, then the newest three."""
    path = fresh_path(spark, "reports")
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for i, report in enumerate(mo.reports(spark, sf_dir)):
        report_store.save_report(report, path, start + timedelta(hours=i))
    newest = report_store.recent_reports(report_store.read_reports(spark, path), 3)
    return mo.long_integers(newest.withColumn("saved_at", F.date_format("saved_at", "yyyy-MM-dd HH:mm:ss")))


def facts_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.long_integers(mo.union_all([
        files.table_facts(table(spark, sf_dir, n)).select(
            F.lit(n).alias("table_name"), "row_count", "column_count", F.array_join("columns", ",").alias("columns"))
        for n in TABLES
    ]))


def nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of one year, then a run of the next year without alerts: the older year's alerts are gone, and the
    empty history counts as stored."""
    path, (weeks, months) = fresh_path(spark, "alert-history"), stored_results(spark, sf_dir)
    first = every_alert(weeks, months)
    update_history(first, path, YEAR_1998)
    update_history(first.limit(0), path, replace(AlertRules(), active_year="1999"))
    return flat_alerts(update_history(first.filter("batch LIKE '1999%'"), path, replace(AlertRules(), active_year="1999")))


def weekly_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly fingerprints written as JSON documents and read back: every entry of both feature maps."""
    path = fresh_path(spark, "weekly-fingerprints")
    documents = stored_results(spark, sf_dir)[0]
    files.write_json(documents, path)
    loaded = files.read_json(spark, path, documents.schema)
    entries = loaded.select("week", "drift_status", "behavioral_similarity_score", "behavioral_features",
                            F.explode("feature_comparison").alias("feature", "c"))
    return mo.rounded(entries.select(
        "week", "drift_status", "behavioral_similarity_score", "feature",
        F.try_element_at("behavioral_features", F.col("feature")).cast("double").alias("value"),
        *[F.col(f"c.{n}").alias(n) for n in ("current", "baseline_mean", "baseline_stddev", "z_score")],
    ))


def health_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of the statistics and outlier maps of the monthly documents."""
    documents = bh.health_documents(mo.stored_months(spark, sf_dir), schema_snapshot(purchases(spark, sf_dir)))
    path = fresh_path(spark, "fingerprints")
    files.write_json(documents, path)
    loaded = files.read_json(spark, path, documents.schema)
    entries = loaded.select("month", "outlier_analysis", F.explode("numerical_statistics").alias("column", "s"))
    fences = F.try_element_at("outlier_analysis", F.col("column"))
    return mo.rounded(entries.select(
        "month", "column", *[F.col(f"s.{n}").alias(n) for n in ("count", "mean", "stddev", "min", "max")],
        *[fences[n].alias(n) for n in ("q1", "q3", "outlier_count", "outlier_percentage")],
    ))


def alerts_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly, monthly and history documents in, history documents out and in again. The history comes as files that
    hold one JSON array each."""
    weeks, months = stored_results(spark, sf_dir)
    monthly_documents = bh.health_documents(months, schema_snapshot(purchases(spark, sf_dir)))
    at = {n: fresh_path(spark, n) for n in ("weekly", "monthly", "history", "merged")}
    files.write_json(weeks, at["weekly"])
    files.write_json(monthly_documents, at["monthly"])
    older = earlier_history(weeks, months)
    # A text line per group of alerts: each file holds whole arrays.
    older.select(F.to_json(F.struct(*older.columns), {"ignoreNullFields": "false"}).alias("value"),
                 F.substring("batch", 1, 7).alias("group")).groupBy("group").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("value")), ","), F.lit("]")).alias("value")
    ).select("value").repartition(1).write.text(at["history"], lineSep="\n")
    read = lambda n, schema: files.read_json(spark, at[n], schema)
    history = read("history", ALERT_SCHEMA)
    new = build_alerts(read("weekly", weeks.schema), read("monthly", monthly_documents.schema), GENERATED)
    files.write_json(alerts.merge_history(alerts.active_history(history, YEAR_1998), new), at["merged"])
    return flat_alerts(read("merged", ALERT_SCHEMA))


def csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables through CSV files into a report, and a file that is none: what a person who sends files gets."""
    rows = []
    for name in ("customer", "part"):
        path = fresh_path(spark, name) + ".csv"
        table(spark, sf_dir, name).write.option("header", True).option("escape", '"').csv(path)
        report, message = report_of_csv(spark, path, f"{name}.parquet", multi_line=False)
        rows.append(mo.flat_report(report).withColumn("message", F.lit(message).cast("string")))
    _, refused = report_of_csv(spark, fresh_path(spark, "part") + ".txt", "part.txt")
    none = [F.lit(None).cast(kind).alias(n) for n, kind in rows[0].dtypes if n not in ("file_name", "message")]
    rows.append(table(spark, sf_dir, "region").groupBy().count().select(
        F.lit("part.txt").alias("file_name"), F.lit(refused).alias("message"), *none))
    return mo.long_integers(mo.union_all(rows))


def csv_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message each faulty export of the purchases is refused with."""
    raw = stored_raw(spark, sf_dir)
    swapped = raw.select("unit_price", "order_date", *[c for c in raw.columns if c not in ("unit_price", "order_date")])
    undated = raw.withColumn("order_date", F.when(F.col("product_code") % 7 != 0, F.col("order_date")))
    found = []
    for fault, df, year in (("swapped header", swapped, 1998), ("bad dates", undated, 1998), ("empty year", raw, 1890)):
        try:
            prepare_to_parquet(spark, csv_export(df), fresh_path(spark, "prepared"), year, ROLES.date,
                               schema=raw.schema, multi_line=False)
            message = None
        except ValueError as error:
            header = "CSV header does not conform to the schema"
            message = header if header in str(error) else str(error)
        found.append((fault, message))
    return spark.createDataFrame(found, "fault string, message string")


def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema text and first five rows by key of three tables, as a loaded table is shown to a person."""
    rows = []
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")):
        df = table(spark, sf_dir, name)
        shown = files.preview(df.orderBy(key)).select(
            F.col(key).alias("row_key"), F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns if dict(df.dtypes)[c] in ("string", "int", "bigint")]).alias("shown"))
        rows.append(shown.select(
            F.lit(name).alias("table_name"), F.lit(df.schema.simpleString()).alias("schema_text"), "row_key", "shown"))
    return mo.union_all(rows)


# ---------------------------------------------------------------------------------------------- SQL

def weekly_sql() -> str:
    """CTEs from weekly features to drift status: ``weeks``, ``tall``, ``zed``, ``drift``, ``top``."""
    columns = mo.COLUMNS
    missing = " + ".join(f"count(*) FILTER (WHERE {n} IS NULL)" for n in columns)
    union = " UNION ALL ".join(
        f"SELECT week_start, first_date, last_date, {i} AS position, '{f}' AS feature, CAST({f} AS DOUBLE) AS current FROM weeks"
        for i, f in enumerate(FEATURES))
    return f""",
dated AS (SELECT *, CAST(date_trunc('week', order_date) AS DATE) AS week_start FROM purchases WHERE order_date IS NOT NULL),
copies_of AS (SELECT week_start, count(*) AS n FROM dated GROUP BY week_start, {', '.join(columns)}),
copy_rate AS (SELECT week_start, CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100.0::DOUBLE AS duplicate_rate FROM copies_of GROUP BY week_start),
weeks AS (SELECT week_start, count(*) AS purchase_record_count, count(DISTINCT response_id) AS survey_response_diversity,
    count(DISTINCT product_code) AS unique_product_code_count, count(DISTINCT category) AS unique_category_count,
    count(DISTINCT state) AS unique_shipping_state_count, avg(quantity) AS average_quantity,
    stddev_samp(quantity) AS quantity_stddev, avg(unit_price) AS average_purchase_price_per_unit,
    stddev_samp(unit_price) AS purchase_price_per_unit_stddev,
    ({missing}) / (count(*) * {len(columns)}) * 100.0::DOUBLE AS missing_value_rate,
    min(order_date) AS first_date, max(order_date) AS last_date, any_value(duplicate_rate) AS duplicate_rate
    FROM dated JOIN copy_rate USING (week_start) GROUP BY week_start),
tall AS ({union}),
based AS (SELECT *, count(*) OVER before AS historical_observations, avg(current) OVER before AS baseline_mean,
    stddev_samp(current) OVER before AS baseline_stddev, min(first_date) OVER own AS source_first,
    max(last_date) OVER own AS source_last FROM tall
    WINDOW before AS (PARTITION BY feature ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      own AS (PARTITION BY feature)),
flagged AS (SELECT *,
    CAST(date_trunc('week', source_first) AS DATE) = week_start AND source_first > week_start AS cut_front,
    CAST(date_trunc('week', source_last) AS DATE) = week_start AND source_last < week_start + 6 AS cut_back FROM based),
zed AS (SELECT *, cut_front OR cut_back AS is_partial_source_window,
    CASE WHEN cut_front AND cut_back THEN 'Partial source window: the {PERIOD} source begins and ends before this calendar week is complete.'
      WHEN cut_front THEN 'Partial source window: genuine {PERIOD} data begins on ' || source_first || ' after this calendar week began.'
      WHEN cut_back THEN 'Partial source window: genuine {PERIOD} data ends on ' || source_last || ' before this calendar week is complete.' END AS source_window_note,
    CASE WHEN feature = 'purchase_record_count' AND (cut_front OR cut_back) THEN NULL
      WHEN historical_observations < 4 OR baseline_stddev IS NULL THEN NULL
      WHEN baseline_stddev > 1e-9 THEN abs((current - baseline_mean) / baseline_stddev)
      WHEN abs(current - baseline_mean) <= 1e-9 THEN 0.0 ELSE 5.0 END AS z_score FROM flagged),
distance AS (SELECT week_start, any_value(historical_observations) AS historical_observations,
    any_value(is_partial_source_window) AS is_partial_source_window, any_value(source_window_note) AS source_window_note,
    count(z_score) AS similarity_scored_feature_count,
    avg(CASE WHEN z_score IS NOT NULL THEN least(z_score, 5.0) END) AS behavioral_distance,
    string_agg(feature, ',' ORDER BY position) FILTER (WHERE z_score IS NOT NULL) AS scored_features FROM zed GROUP BY week_start),
similarity AS (SELECT *, CASE WHEN historical_observations >= 4
    THEN round(greatest(0.0::DOUBLE, 100.0::DOUBLE - behavioral_distance * 20.0::DOUBLE), 2) END AS behavioral_similarity_score FROM distance),
drift AS (SELECT *, CASE WHEN historical_observations < 4 THEN 'Baseline Building'
    WHEN behavioral_similarity_score IS NULL THEN 'Insufficient History' WHEN behavioral_similarity_score >= 80 THEN 'Normal'
    WHEN behavioral_similarity_score >= 55 THEN 'Moderate Drift' ELSE 'Major Drift' END AS drift_status FROM similarity),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week_start ORDER BY z_score DESC, position) AS rank
    FROM zed WHERE z_score IS NOT NULL) WHERE rank <= 3),
top_by AS (SELECT week_start, string_agg(feature, ',' ORDER BY rank) AS features FROM top GROUP BY week_start)"""


def alerts_sql() -> str:
    """CTEs on top of the weekly and monthly ones: ``behavior``, ``months``, ``alerts``."""
    def behavior_rows(critical: float, prefix: str) -> str:
        return f"""SELECT '{prefix}' || strftime(week_start, '%Y-%m-%d') AS alert_id, 'Behavioral Drift' AS alert_type,
      strftime(week_start, '%Y-%m-%d') AS batch, strftime(week_start, '%Y-%m-%d') AS batch_timestamp,
      CASE WHEN behavioral_similarity_score < {critical} THEN 'CRITICAL' WHEN drift_status = 'Major Drift' THEN 'HIGH' ELSE 'WARNING' END AS severity,
      behavioral_similarity_score AS similarity_score, drift_status,
      drift_status || ': behavioural similarity is ' || CAST(behavioral_similarity_score AS VARCHAR) || '/100. Top deviations: '
        || coalesce(replace(replace(features, '_', ' '), ',', ', '), 'not available') || '.'
        || CASE WHEN is_partial_source_window THEN ' ' || source_window_note
          || ' Transaction volume is excluded from behavioural similarity scoring for this source-truncated week.' ELSE '' END AS trigger,
      features, CAST(NULL AS VARCHAR) AS anomalies, source_window_note, '{GENERATED}' AS generated_timestamp
      FROM drift LEFT JOIN top_by USING (week_start)
      WHERE historical_observations >= 4 AND drift_status IN ('Moderate Drift', 'Major Drift')"""

    def month_rows(status: str, severity: str, generated: str) -> str:
        return f"""SELECT 'data-health-' || batch AS alert_id, 'Data Health' AS alert_type, batch, batch AS batch_timestamp,
      '{severity}' AS severity, CAST(NULL AS DOUBLE) AS similarity_score, CAST(NULL AS VARCHAR) AS drift_status,
      'Implementation 1 Data Health Score is ' || health_score || '/100: ' || anomalies AS trigger,
      CAST(NULL AS VARCHAR) AS features, anomalies, CAST(NULL AS VARCHAR) AS source_window_note,
      '{generated}' AS generated_timestamp FROM health WHERE health_status = '{status}'"""

    return mo.health_sql() + weekly_sql() + f""",
behavior AS ({behavior_rows(35.0, 'behavioral-')}),
months AS ({month_rows('Critical', 'CRITICAL', GENERATED)}),
alerts AS (SELECT * FROM behavior UNION ALL SELECT * FROM months),
old AS ({behavior_rows(50.0, 'legacy-behavioral-')} UNION ALL {month_rows('Warning', 'WARNING', '2023-01-01T00:00:00+00:00')}),
merged AS (SELECT * FROM alerts UNION ALL SELECT * FROM old o WHERE batch LIKE '1998%'
  AND NOT EXISTS (SELECT 1 FROM alerts a WHERE a.alert_type = o.alert_type AND a.batch = o.batch)),
ranked AS (SELECT w.week, w.score, a.severity, a.trigger, a.batch_timestamp, a.alert_id,
    CASE a.severity WHEN 'WARNING' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 END AS level
  FROM (SELECT strftime(week_start, '%Y-%m-%d') AS week, behavioral_similarity_score AS score FROM drift) w
  LEFT JOIN alerts a ON a.batch = w.week OR (a.alert_type = 'Data Health' AND a.batch = left(w.week, 7)))"""


def preview_sql() -> str:
    """First five rows by key of the previewed tables, beside the text of their schema."""
    shown = {
        "orders": ("o_orderkey", "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]),
        "customer": ("c_custkey", "struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>",
                     ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]),
        "part": ("p_partkey", "struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:int,p_retailprice:double>",
                 ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]),
    }
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{n}' AS table_name, '{text}' AS schema_text, {key} AS row_key,
        concat_ws('|', {', '.join(columns)}) AS shown FROM {n} ORDER BY {key} LIMIT 5)""" for n, (key, text, columns) in shown.items())


def queries() -> dict:
    r = mo.rounded
    out_features = lambda s, d: r(features(s, d).drop("first_date", "last_date"))
    return {
        "validation_summary": lambda s, d: cleaning.validation_summary(typed_csv(s, d), ROLES.date, 1998),
        "csv_roundtrip": typed_csv,
        "prepare_from_csv": prepared_year,
        "any_csv": inferred_csv,
        "json_roundtrip": health_json,
        "json_health_maps": health_maps,
        "weekly_json": weekly_json,
        "alerts_from_json": alerts_from_json,
        "csv_report": csv_report,
        "csv_rejections": csv_rejections,
        "table_preview": previews,
        "history_year_change": nothing_new,
        "week_message": lambda s, d: views.week_message(stored_scores(s, d)),
        "latest_week_comparison": lambda s, d: r(views.week_comparison(stored_comparison(s, d), views.LATEST)),
        "chosen_week_deviations": lambda s, d: mo.long_integers(r(views.labelled_deviations(
            stored_scores(s, d), CHOSEN_WEEK))),
        "json_missing_map": missing_json,
        "report_store": report_history,
        "recent_reports": lambda s, d: mo.long_integers(report_store.recent_reports(mo.union_all([
            report_store.stamped(report, datetime(2024, 1, 1, hour, tzinfo=timezone.utc))
            for hour, report in enumerate(mo.reports(s, d))])).drop("saved_at")),
        "table_facts": facts_of_tables,
        "weekly_features": out_features,
        "csv_quarantine": csv_quarantine,
        "footer_facts": footer_facts,
        "distinct_spans": distinct_spans,
        "weekly_incremental": lambda s, d: r(incremental_weeks(s, d).drop("first_date", "last_date")),
        "monthly_incremental": lambda s, d: mo.rounded(mo.labelled(incremental_months(s, d))),
        "weekly_partial_window": lambda s, d: weekly.partial_weeks(
            weekly.week_dates(purchases(s, d), ROLES.date), PERIOD).select(
            "week_start", "first_date", "last_date", "is_partial_source_window", "source_window_note"),
        "weekly_baseline": lambda s, d: r(comparison(s, d).select(
            "week_start", "feature", "historical_observations", "baseline_mean", "baseline_stddev")),
        "weekly_zscores": lambda s, d: r(comparison(s, d).select("week_start", "feature", "current", "z_score")),
        "weekly_drift": lambda s, d: r(scores(s, d).select(
            "week_start", "historical_observations", "is_partial_source_window", "similarity_scored_feature_count",
            "behavioral_distance", "behavioral_similarity_score", "drift_status")),
        "top_deviations": lambda s, d: r(scores(s, d).select("week_start", F.inline("top_deviating_features"))),
        "weekly_fingerprint_nested": lambda s, d: fingerprints(s, d).select(
            "week", "source_window_note", "baseline_ready", "historical_observations",
            F.array_join("similarity_scored_features", ",").alias("scored_features"),
            F.array_join(F.transform("excluded_from_similarity_features", lambda x: F.concat_ws(
                ": ", x["feature"], x["reason"])), ",").alias("excluded_features"),
            F.round(F.col("behavioral_features")["missing_value_rate"], 4).alias("missing_value_rate"),
            F.round(F.col("feature_comparison")["duplicate_rate"]["z_score"], 4).alias("duplicate_z"),
            "behavioral_similarity_score", "drift_status",
            F.array_join(F.transform("top_deviating_features", lambda x: x["feature"]), ",").alias("top_features")),
        "behavior_alerts": lambda s, d: flat_alerts(alerts.behavior_alerts(stored_results(s, d)[0], GENERATED)),
        "health_alerts": lambda s, d: flat_alerts(alerts.health_alerts(mo.stored_months(s, d), GENERATED)),
        "all_alerts": lambda s, d: flat_alerts(every_alert(*stored_results(s, d))),
        "merged_history": lambda s, d: flat_alerts(merged(s, d)),
        "stored_history": lambda s, d: flat_alerts(stored_alerts(s, d)),
        "week_status": week_status,
        "alert_listing": lambda s, d: alerts.alert_listing(
            every_alert(*stored_results(s, d))),
        "labelled_deviations": lambda s, d: mo.long_integers(r(views.labelled_deviations(stored_scores(s, d)))),
        "week_comparison": lambda s, d: r(views.week_comparison(stored_comparison(s, d))),
        "weekly_trend": lambda s, d: views.weekly_trend(stored_scores(s, d)),
        "overview": lambda s, d: views.overview(mo.stored_months(s, d), stored_scores(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    week = lambda body: mo.with_purchases(body, weekly_sql())
    alert = lambda body: mo.with_purchases(body, alerts_sql())
    health = lambda body: mo.with_purchases(body, mo.health_sql())
    rounded_features = ", ".join(f"round(CAST({f} AS DOUBLE), 4) AS {f}" for f in FEATURES)
    label = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEATURE_LABELS.items()) + " END"
    spoiled = "CASE WHEN product_code % 7 <> 0 THEN order_date END"
    reports = f"SELECT file_name, data_health_score, health_status, row_count, column_count FROM ({mo.report_rows_sql()})"
    hours = " ".join(f"WHEN '{n}.parquet' THEN '2024-01-01 {i:02d}:00:00'" for i, n in enumerate(mo.REPORTED))
    facts = " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS row_count, count(*) AS column_count,
        string_agg(column_name, ',' ORDER BY column_index) AS columns FROM duckdb_columns() WHERE table_name = '{n}'"""
        for n in TABLES)
    return {
        "validation_summary": mo.with_purchases(
            f"""SELECT count(*) FILTER (WHERE d IS NULL) AS invalid_dates, count(*) FILTER (WHERE year(d) = 1998) AS records,
            min(d) FILTER (WHERE year(d) = 1998) AS earliest_date, max(d) FILTER (WHERE year(d) = 1998) AS latest_date
            FROM (SELECT {spoiled} AS d FROM raw)"""),
        "json_health_maps": health(
            f"""SELECT s.batch AS month, s."column", s."count", s.mean, s.stddev, s.min, s.max, o.q1, o.q3, o.outlier_count,
            o.outlier_percentage FROM ({mo.stats_sql('purchases', mo.MONTH, mo.NUMERIC, 'records')}) s
            JOIN outl o ON o.batch = s.batch AND o."column" = s."column\""""),
        "weekly_json": week(
            f"""SELECT strftime(week_start, '%Y-%m-%d') AS week, drift_status, behavioral_similarity_score, feature,
            round(current, 4) AS value, round(current, 4) AS current, round(baseline_mean, 4) AS baseline_mean,
            round(baseline_stddev, 4) AS baseline_stddev, round(z_score, 4) AS z_score
            FROM zed JOIN (SELECT week_start, drift_status, behavioral_similarity_score FROM drift) USING (week_start)"""),
        "alerts_from_json": alert("SELECT * FROM merged"),
        "csv_report": f"""SELECT r.*, CAST(NULL AS VARCHAR) AS message FROM ({mo.report_rows_sql()}) r
            WHERE file_name IN ('customer.parquet', 'part.parquet')
            UNION ALL BY NAME SELECT 'part.txt' AS file_name, 'Please upload a valid .csv file.' AS message""",
        "csv_rejections": mo.with_purchases(
            f"""SELECT 'swapped header' AS fault, 'CSV header does not conform to the schema' AS message
            UNION ALL SELECT 'bad dates', 'Found ' || count(*) || ' null or unparseable order_date values.'
              FROM raw WHERE product_code % 7 = 0
            UNION ALL SELECT 'empty year', CASE WHEN count(*) = 0 THEN 'No genuine 1890 purchase records were found.' END
              FROM raw WHERE year(order_date) = 1890"""),
        "table_preview": preview_sql(),
        "history_year_change": alert("SELECT * FROM alerts WHERE batch LIKE '1999%'"),
        "week_message": week(
            """SELECT week_start, drift_status, source_window_note, CASE drift_status WHEN 'Normal' THEN 'INFO / NORMAL'
              WHEN 'Moderate Drift' THEN 'WARNING' WHEN 'Major Drift' THEN 'HIGH' END AS severity,
            CASE drift_status WHEN 'Normal' THEN 'Weekly purchase behaviour is consistent with the prior-only historical baseline.'
              WHEN 'Moderate Drift' THEN 'Weekly purchase behaviour shows moderate drift from the prior-only historical baseline.'
              WHEN 'Major Drift' THEN 'Weekly purchase behaviour shows major drift from the prior-only historical baseline.'
              ELSE 'Behavioral Similarity Score: N/A. Drift Status: Baseline Building. Four earlier weekly batches and valid feature statistics are required before scoring.' END AS message
            FROM drift"""),
        "latest_week_comparison": week(
            f"""SELECT week_start, {label} AS feature, round(current, 4) AS current, round(baseline_mean, 4) AS baseline_mean,
            round(baseline_stddev, 4) AS baseline_stddev, round(z_score, 4) AS z_score FROM zed
            WHERE week_start = (SELECT max(week_start) FROM zed)"""),
        "chosen_week_deviations": week(
            f"""SELECT week_start, rank, {label} AS feature, round(z_score, 4) AS z_score, round(current, 4) AS current,
            round(baseline_mean, 4) AS baseline_mean FROM top WHERE week_start = DATE '{CHOSEN_WEEK}'"""),
        "csv_roundtrip": mo.with_purchases(f"SELECT * REPLACE ({spoiled} AS order_date) FROM raw"),
        "prepare_from_csv": mo.with_purchases("SELECT * FROM purchases WHERE year(order_date) = 1998"),
        "any_csv": mo.stats_sql("orders", "", ["o_orderkey", "o_custkey", "o_totalprice"], "valid"),
        "json_roundtrip": health(f"SELECT {mo.HEALTH_COLUMNS} FROM health"),
        "json_missing_map": health(
            'SELECT batch AS month, health_status AS severity, "column", missing_count FROM miss JOIN health USING (batch)'),
        "report_store": f"""SELECT *, CASE file_name {hours} END AS saved_at FROM ({reports})
            ORDER BY saved_at DESC LIMIT 3""",
        "recent_reports": reports,
        "table_facts": facts,
        "weekly_features": week(f"SELECT week_start, {rounded_features} FROM weeks"),
        "csv_quarantine": mo.with_purchases(QUARANTINE_SQL),
        "footer_facts": mo.with_purchases(
            "SELECT count(*) AS row_count, min(order_date) AS earliest_date, max(order_date) AS latest_date FROM purchases"),
        "distinct_spans": distinct_spans_sql(),
        "weekly_incremental": week(f"SELECT week_start, {rounded_features} FROM weeks"),
        "monthly_incremental": mo.with_purchases(mo.stats_sql("purchases", mo.MONTH, mo.NUMERIC, "records")),
        "weekly_partial_window": week(
            """SELECT week_start, first_date, last_date, is_partial_source_window, source_window_note FROM zed
            WHERE position = 0"""),
        "weekly_baseline": week(
            """SELECT week_start, feature, historical_observations, round(baseline_mean, 4) AS baseline_mean,
            round(baseline_stddev, 4) AS baseline_stddev FROM zed"""),
        "weekly_zscores": week(
            "SELECT week_start, feature, round(current, 4) AS current, round(z_score, 4) AS z_score FROM zed"),
        "weekly_drift": week(
            """SELECT week_start, historical_observations, is_partial_source_window, similarity_scored_feature_count,
            round(behavioral_distance, 4) AS behavioral_distance, behavioral_similarity_score, drift_status FROM drift"""),
        "top_deviations": week(
            """SELECT week_start, feature, round(z_score, 4) AS z_score, round(current, 4) AS current,
            round(baseline_mean, 4) AS baseline_mean FROM top"""),
        "weekly_fingerprint_nested": week(
            f"""SELECT strftime(week_start, '%Y-%m-%d') AS week, source_window_note, historical_observations >= 4 AS baseline_ready,
            historical_observations, coalesce(scored_features, '') AS scored_features,
            CASE WHEN is_partial_source_window THEN 'purchase_record_count: Excluded from similarity scoring because the genuine {PERIOD} source period does not cover this full calendar week.' ELSE '' END AS excluded_features,
            round(missing_value_rate, 4) AS missing_value_rate, round(z.z_score, 4) AS duplicate_z,
            behavioral_similarity_score, drift_status, coalesce(features, '') AS top_features
            FROM drift JOIN (SELECT week_start, missing_value_rate FROM weeks) USING (week_start)
            JOIN (SELECT week_start, z_score FROM zed WHERE feature = 'duplicate_rate') z USING (week_start)
            LEFT JOIN top_by USING (week_start)"""),
        "behavior_alerts": alert("SELECT * FROM behavior"),
        "health_alerts": alert("SELECT * FROM months"),
        "all_alerts": alert("SELECT * FROM alerts"),
        "merged_history": alert("SELECT * FROM merged"),
        "stored_history": alert("SELECT * FROM merged"),
        "week_status": alert(
            """SELECT week, score AS behavioral_similarity_score,
            coalesce(first(severity ORDER BY level DESC, batch_timestamp, alert_id), 'INFO / NORMAL') AS status,
            first(trigger ORDER BY level DESC, batch_timestamp, alert_id) AS trigger,
            count(severity) AS applicable_alerts FROM ranked GROUP BY week, score"""),
        "alert_listing": alert(
            """SELECT alert_id, batch, alert_type AS type, severity, similarity_score AS similarity,
            CASE WHEN trigger IS NULL OR trigger = '' THEN 'No reason recorded' WHEN length(trigger) <= 105 THEN trigger
              ELSE regexp_replace(left(trigger, 104), '\\s+$', '') || '…' END AS reason,
            generated_timestamp AS generated FROM alerts"""),
        "labelled_deviations": week(
            f"""SELECT week_start, rank, {label} AS feature, round(z_score, 4) AS z_score, round(current, 4) AS current,
            round(baseline_mean, 4) AS baseline_mean FROM top"""),
        "week_comparison": week(
            f"""SELECT week_start, {label} AS feature, round(current, 4) AS current, round(baseline_mean, 4) AS baseline_mean,
            round(baseline_stddev, 4) AS baseline_stddev, round(z_score, 4) AS z_score FROM zed"""),
        "weekly_trend": week("SELECT week_start, behavioral_similarity_score FROM drift"),
        "overview": mo.with_purchases(
            "SELECT count(*) AS total_records, count(DISTINCT date_trunc('week', order_date)) AS weekly_batches FROM purchases"),
    }
