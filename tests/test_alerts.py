"""Alert rules, history merge, stores and the batch-triggered feed."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import alerts
from pulseframe.plans.alerting import refresh_alerts
from pulseframe.rules import AlertRules
from pulseframe.sources import alert_store, files, report_store
from pulseframe.sources.paths import Folder
from pulseframe.streaming.alert_feed import alert_feed, fingerprint_feed

WEEKS = (
    "week string, baseline_ready boolean, behavioral_similarity_score double, drift_status string, "
    "is_partial_source_window boolean, source_window_note string, "
    "top_deviating_features array<struct<feature:string,z_score:double,current:double,baseline_mean:double>>"
)
MONTHS = "month string, health_score int, health_status string, data_quality_anomalies array<string>"
NOW = "2024-01-01T00:00:00+00:00"
NOTE = "Partial source window: genuine 2022 data ends on 2022-12-31 before this calendar week is complete."

# Published monitoring results the rules must reproduce: week, score, status, severity, top features.
KNOWN = [
    ("2022-03-14", 68.76, "Moderate Drift", "WARNING", "quantity_stddev average_quantity duplicate_rate"),
    ("2022-06-20", 79.76, "Moderate Drift", "WARNING",
     "average_purchase_price_per_unit unique_shipping_state_count purchase_price_per_unit_stddev"),
    ("2022-07-11", 53.45, "Major Drift", "HIGH",
     "average_purchase_price_per_unit purchase_record_count unique_product_code_count"),
    ("2022-10-10", 73.88, "Moderate Drift", "WARNING",
     "missing_value_rate average_purchase_price_per_unit duplicate_rate"),
    ("2022-11-21", 74.68, "Moderate Drift", "WARNING",
     "average_purchase_price_per_unit unique_product_code_count purchase_record_count"),
    ("2022-12-05", 78.81, "Moderate Drift", "WARNING", "duplicate_rate survey_response_diversity quantity_stddev"),
    ("2022-12-19", 74.63, "Moderate Drift", "WARNING",
     "survey_response_diversity unique_product_code_count purchase_record_count"),
    ("2022-12-26", 70.25, "Moderate Drift", "WARNING",
     "survey_response_diversity unique_product_code_count unique_category_count"),
]


def week(batch, score, status, features="a_b", ready=True, note=None):
    top = [(f, 1.0, 2.0, 3.0) for f in features.split()]
    return (batch, ready, score, status, note is not None, note, top)


def behavior(spark, *rows, **options):
    return alerts.behavior_alerts(spark.createDataFrame(list(rows), WEEKS), NOW, **options)


def months(spark, *rows):
    return alerts.health_alerts(spark.createDataFrame(list(rows), MONTHS), NOW, "month")


def test_known_alerts(spark):
    rows = [week(b, s, d, f, note=NOTE if b == "2022-12-26" else None) for b, s, d, _, f in KNOWN]
    found = alerts.in_alert_order(behavior(spark, *rows)).collect()
    assert [(a["alert_id"], a["severity"]) for a in found] == [(f"behavioral-{k[0]}", k[3]) for k in KNOWN]
    assert found[0]["trigger"] == (
        "Moderate Drift: behavioural similarity is 68.76/100. Top deviations: quantity stddev, average quantity, "
        "duplicate rate."
    )
    assert found[-1]["trigger"] == (
        "Moderate Drift: behavioural similarity is 70.25/100. Top deviations: survey response diversity, "
        f"unique product code count, unique category count. {NOTE} Transaction volume is excluded from behavioural "
        "similarity scoring for this source-truncated week."
    )
    assert found[0]["generated_timestamp"] == NOW and found[0]["anomalies"] is None


@pytest.mark.parametrize("score, status, ready, severity", [
    (34.99, "Major Drift", True, "CRITICAL"), (35.0, "Major Drift", True, "HIGH"),
    (60.0, "Moderate Drift", True, "WARNING"), (90.0, "Normal", True, None),
    (None, "Baseline Building", True, None), (None, "Insufficient History", True, None),
    (10.0, "Major Drift", False, None),
])
def test_severity(spark, score, status, ready, severity):
    found = behavior(spark, week("2022-01-31", score, status, ready=ready)).collect()
    assert [a["severity"] for a in found] == ([severity] if severity else [])


def test_trigger_without_features_and_with_whole_score(spark):
    found = behavior(spark, week("2022-01-31", 60.0, "Moderate Drift", features="")).first()
    assert found["trigger"] == "Moderate Drift: behavioural similarity is 60.0/100. Top deviations: not available."


def test_health_alerts_are_for_critical_batches(spark):
    found = months(
        spark, ("2022-03", 50, "Critical", ["One.", "Two."]), ("2022-04", 80, "Warning", ["x"]),
        ("2022-05", 100, "Healthy", [])).collect()
    assert len(found) == 1
    assert found[0]["alert_id"] == "data-health-2022-03" and found[0]["severity"] == "CRITICAL"
    assert found[0]["trigger"] == "Implementation 1 Data Health Score is 50/100: One.; Two."
    assert found[0]["anomalies"] == ["One.", "Two."] and found[0]["top_deviating_features"] is None


def test_merge_replaces_keeps_and_migrates_ids(spark):
    new = behavior(spark, week("2022-02-07", 40.0, "Major Drift"), week("2022-02-14", 70.0, "Moderate Drift"))
    old = behavior(spark, week("2022-02-07", 70.0, "Moderate Drift"), week("2022-01-31", 60.0, "Moderate Drift"))
    old = old.withColumn("alert_id", F.concat(F.lit("zz-"), "batch"))
    once = alerts.merge_history(old, new)
    rows = once.collect()
    assert [(r["batch"], r["alert_id"], r["severity"]) for r in rows] == [
        ("2022-01-31", "zz-2022-01-31", "WARNING"), ("2022-02-07", "behavioral-2022-02-07", "HIGH"),
        ("2022-02-14", "behavioral-2022-02-14", "WARNING"),
    ]
    assert alerts.merge_history(once, new).collect() == rows


def test_same_batch_name_of_other_type_is_another_alert(spark):
    merged = alerts.merge_history(
        behavior(spark, week("2022-03", 60.0, "Moderate Drift")), months(spark, ("2022-03", 50, "Critical", ["x"])))
    assert merged.count() == 2


def test_only_the_active_year_is_kept(spark):
    history = behavior(spark, week("2021-12-27", 60.0, "Moderate Drift"), week("2022-01-03", 60.0, "Moderate Drift"))
    assert [r["batch"] for r in alerts.active_history(history).collect()] == ["2022-01-03"]


def test_store_snapshots(spark, tmp_path):
    path = str(tmp_path / "history")
    assert alert_store.load_history(spark, path).count() == 0
    first = behavior(spark, week("2021-05-03", 60.0, "Moderate Drift"), week("2022-01-03", 60.0, "Moderate Drift"))
    assert alert_store.update_history(first, path).count() == 2
    second = behavior(spark, week("2022-01-10", 20.0, "Major Drift"))
    for _ in range(2):
        rows = alert_store.update_history(second, path).collect()
        assert [(r["batch"], r["severity"]) for r in rows] == [("2022-01-03", "WARNING"), ("2022-01-10", "CRITICAL")]


def stored(spark, path):
    return [(r["batch"], r["severity"]) for r in alert_store.load_history(spark, path).collect()]


def test_a_run_without_alerts_in_a_new_year_empties_the_history(spark, tmp_path):
    path = str(tmp_path / "history")
    first = behavior(spark, week("2022-01-03", 60.0, "Moderate Drift"))
    assert alert_store.update_history(first, path).count() == 1
    assert alert_store.update_history(first.limit(0), path, AlertRules(active_year="2023")).count() == 0
    assert stored(spark, path) == []


def test_snapshots_without_a_commit_do_not_count(spark, tmp_path):
    path = str(tmp_path / "history")
    first = behavior(spark, week("2022-01-03", 60.0, "Moderate Drift"))
    alert_store.update_history(first, path)
    behavior(spark, week("2022-02-07", 40.0, "Major Drift")).write.parquet(f"{path}/snapshots/unfinished")
    assert stored(spark, path) == [("2022-01-03", "WARNING")]


def test_a_writer_that_lost_the_race_merges_again(spark, tmp_path, monkeypatch):
    path, create = str(tmp_path / "history"), Folder.create
    other = behavior(spark, week("2022-02-07", 40.0, "Major Drift"))
    raced = []

    def late(folder, name, content):
        if not raced:
            raced.append(name)
            alert_store.update_history(other, path)
        return create(folder, name, content)

    monkeypatch.setattr(Folder, "create", late)
    alert_store.update_history(behavior(spark, week("2022-01-03", 60.0, "Moderate Drift")), path)
    assert stored(spark, path) == [("2022-01-03", "WARNING"), ("2022-02-07", "HIGH")]


def test_old_snapshots_are_retired(spark, tmp_path):
    path = str(tmp_path / "history")
    for n in range(5):
        alert_store.update_history(behavior(spark, week(f"2022-01-{10 + 7 * (n % 3)}", 60.0, "Moderate Drift")), path, kept=2)
    assert len(Folder(spark, f"{path}/commits").names()) == len(Folder(spark, f"{path}/snapshots").names()) == 3
    assert len(stored(spark, path)) == 3


def test_of_alerts_for_one_batch_the_last_generated_wins(spark):
    older = behavior(spark, week("2022-01-03", 60.0, "Moderate Drift")).withColumn("generated_timestamp", F.lit("2024-01-01"))
    newer = behavior(spark, week("2022-01-03", 40.0, "Major Drift")).withColumn("generated_timestamp", F.lit("2024-01-02"))
    none = older.limit(0)
    for run in (older.unionByName(newer), newer.unionByName(older)):
        assert [r["severity"] for r in alerts.merge_history(none, run).collect()] == ["HIGH"]
    same = behavior(spark, week("2022-01-03", 60.0, "Moderate Drift"), week("2022-01-03", 40.0, "Major Drift"))
    ways = [alerts.merge_history(none, same.orderBy(F.col("severity").asc() if up else F.col("severity").desc())).collect() for up in (True, False)]
    assert ways[0] == ways[1]


def test_refresh_from_weekly_and_monthly_results(spark, tmp_path):
    weeks = spark.createDataFrame([week("2022-01-31", 60.0, "Moderate Drift")], WEEKS)
    health = spark.createDataFrame([("2022-01", 10, "Critical", ["x"])], MONTHS)
    moment = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = refresh_alerts(weeks, health, str(tmp_path / "h"), generated=moment).collect()
    assert [r["alert_id"] for r in rows] == ["data-health-2022-01", "behavioral-2022-01-31"]
    assert rows[0]["generated_timestamp"] == NOW


def test_week_status_takes_the_worst_of_week_and_month(spark):
    weeks = spark.createDataFrame([(w, 50.0) for w in ("2022-01-31", "2022-02-07", "2022-03-07", "2022-04-04")],
                                  "week string, behavioral_similarity_score double")
    raised = behavior(
        spark, week("2022-01-31", 60.0, "Moderate Drift"), week("2022-02-07", 40.0, "Major Drift"),
        week("2022-03-07", 10.0, "Major Drift"),
    ).unionByName(months(spark, ("2022-02", 50, "Critical", ["gap"]), ("2022-03", 40, "Critical", ["gap"])))
    rows = {r["week"]: r for r in alerts.week_status(weeks, raised).collect()}
    assert {w: r["status"] for w, r in rows.items()} == {
        "2022-01-31": "WARNING", "2022-02-07": "CRITICAL", "2022-03-07": "CRITICAL", "2022-04-04": "INFO / NORMAL"}
    assert {w: r["applicable_alerts"] for w, r in rows.items()} == {
        "2022-01-31": 1, "2022-02-07": 2, "2022-03-07": 2, "2022-04-04": 0}
    # Two critical alerts: the month's comes first in alert order.
    assert rows["2022-03-07"]["trigger"].startswith("Implementation 1")
    assert rows["2022-04-04"]["trigger"] is None


@pytest.mark.parametrize("reason, shown", [
    (None, "No reason recorded"), ("", "No reason recorded"), ("x" * 105, "x" * 105),
    ("x" * 106, "x" * 104 + "…"), ("x" * 100 + "    " + "y" * 9, "x" * 100 + "…"),
])
def test_short_reason(spark, reason, shown):
    row = spark.createDataFrame([(reason,)], "r string").select(alerts.short_reason(F.col("r")).alias("r")).first()
    assert row["r"] == shown


def test_listing_is_newest_first(spark):
    raised = behavior(spark, week("2022-01-31", 60.0, "Moderate Drift"), week("2022-02-07", 40.0, "Major Drift"))
    assert [r["batch"] for r in alerts.alert_listing(raised).collect()] == ["2022-02-07", "2022-01-31"]


def test_reports_are_appended_and_listed(spark, tmp_path):
    path = str(tmp_path / "reports")
    schema = "file_name string, data_health_score int, health_status string, row_count bigint, column_count int"
    for i, name in enumerate(["a.csv", None, "c.csv"]):
        report = spark.createDataFrame([(name, 90, "HEALTHY", 5, 2)], schema)
        assert report_store.save_report(report, path, datetime(2024, 1, 1, i, tzinfo=timezone.utc))
    stored = report_store.read_reports(spark, path)
    assert stored.select("report_id").distinct().count() == 3
    assert {r["report_type"] for r in stored.collect()} == {"uploaded_dataset_health"}
    rows = report_store.recent_reports(stored, 2).collect()
    assert [r["file_name"] for r in rows] == ["c.csv", "Unknown"]


def test_feed_merges_arriving_fingerprints(spark, tmp_path):
    folder, history, checkpoint = (str(tmp_path / n) for n in ("feed", "history", "checkpoint"))
    schema = spark.createDataFrame([], WEEKS).schema

    def run(*rows):
        files.write_json(spark.createDataFrame(list(rows), WEEKS), folder, mode="append")
        query = alert_feed(fingerprint_feed(spark, folder, schema), history, checkpoint, generated=NOW)
        query.awaitTermination()
        return [(r["batch"], r["severity"]) for r in alert_store.load_history(spark, history).collect()]

    assert run(week("2022-01-31", 60.0, "Moderate Drift")) == [("2022-01-31", "WARNING")]
    found = run(week("2022-01-31", 40.0, "Major Drift"), week("2022-02-07", 20.0, "Major Drift", note=NOTE))
    assert sorted(found) == [("2022-01-31", "HIGH"), ("2022-02-07", "CRITICAL")]


def test_feed_stamps_alerts_with_the_time_of_the_merge(spark, tmp_path):
    folder, history = str(tmp_path / "feed"), str(tmp_path / "history")
    files.write_json(spark.createDataFrame([week("2022-01-31", 60.0, "Moderate Drift")], WEEKS), folder)
    feed = fingerprint_feed(spark, folder, spark.createDataFrame([], WEEKS).schema)
    alert_feed(feed, history, str(tmp_path / "checkpoint")).awaitTermination()
    assert alert_store.load_history(spark, history).first()["generated_timestamp"].startswith("20")
