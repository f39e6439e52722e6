"""Weekly features, baseline, z-scores and drift on hand-made rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import weekly
from pulseframe.plans.weekly_drift import weekly_fingerprints, weekly_scores
from pulseframe.rules import DriftRules, FEATURE_LABELS, Roles

ROLES = Roles("d", "e", "p", "c", "r", "q", "u")
SCHEMA = "d date, e string, p string, c string, r string, q double, u double"
MONDAY = date(2022, 1, 3)
FEATURES = list(FEATURE_LABELS)


def weekly_rows(spark, values, feature="average_quantity"):
    """A weekly feature table in which one feature takes ``values`` and the others stay at 1."""
    rows = [
        (MONDAY + timedelta(weeks=i), *[float(v) if (f == feature and v is not None) else (None if f == feature else 1.0)
                                       for f in FEATURES],
         MONDAY, MONDAY + timedelta(weeks=len(values) - 1, days=6))
        for i, v in enumerate(values)
    ]
    schema = "week_start date, " + ", ".join(f"{f} double" for f in FEATURES) + ", first_date date, last_date date"
    return spark.createDataFrame(rows, schema)


def last_z(spark, values, limits=DriftRules(), feature="average_quantity"):
    rows = weekly.compare_to_history(weekly_rows(spark, values, feature), limits).filter(
        F.col("feature") == feature).orderBy("week_start").collect()
    return rows[-1]["z_score"]


@pytest.mark.parametrize("history, current, expected", [
    ([10, 20, 30], 25, None),
    ([10, 20, 30, 40], 25, 0.0),
    ([10, 20, 30, 40], 70, 45 / 12.909944487358056),
    ([5, 5, 5, 5], 5, 0.0),
    ([5, 5, 5, 5], 6, 5.0),
    ([5, 5, 5, 5], None, 5.0),
    ([10, 20, 30, 40], None, None),
    ([None, None, None, 7], 7, None),
])
def test_z_score_edges(spark, history, current, expected):
    found = last_z(spark, history + [current])
    assert found == (None if expected is None else pytest.approx(expected))


def test_null_feature_can_be_skipped(spark):
    assert last_z(spark, [5, 5, 5, 5, None], DriftRules(null_feature="skip")) is None


@pytest.mark.parametrize("score, weeks, status", [
    (80.0, 4, "Normal"), (79.99, 4, "Moderate Drift"), (55.0, 9, "Moderate Drift"), (54.99, 9, "Major Drift"),
    (0.0, 9, "Major Drift"), (None, 4, "Insufficient History"), (99.0, 3, "Baseline Building"),
])
def test_status_edges(spark, score, weeks, status):
    row = spark.createDataFrame([(score, weeks)], "s double, w int").select(
        weekly.drift_status(F.col("s"), F.col("w"), DriftRules()).alias("status")).first()
    assert row["status"] == status


def test_similarity_is_hundred_minus_twenty_per_mean_z(spark):
    last = weekly.weekly_drift(weekly.compare_to_history(weekly_rows(spark, [10, 20, 30, 40, 70]))).orderBy(
        F.desc("week_start")).first()
    assert last["similarity_scored_feature_count"] == 11
    assert last["behavioral_similarity_score"] == round(100 - 20 * (45 / 12.909944487358056) / 11, 2)


def test_distance_is_capped_and_never_below_zero(spark):
    tall = weekly.compare_to_history(weekly_rows(spark, [1, 1, 1, 1, 1])).withColumn(
        "z_score", F.when(F.col("historical_observations") >= 4, F.lit(900.0)))
    assert weekly.weekly_drift(tall).orderBy(F.desc("week_start")).first()["behavioral_similarity_score"] == 0.0


def test_top_features_ties_follow_feature_order(spark):
    features = weekly_rows(spark, [1] * 5)
    shifted = features.select("week_start", *[
        F.when(F.col("week_start") == MONDAY + timedelta(weeks=4), 2.0).otherwise(1.0).alias(f) for f in FEATURES
    ], "first_date", "last_date")
    last = weekly.weekly_drift(weekly.compare_to_history(shifted)).orderBy(F.desc("week_start")).first()
    assert [t["feature"] for t in last["top_deviating_features"]] == FEATURES[:3]
    assert last["drift_status"] == "Major Drift"


def purchases(spark, first, last):
    """Three purchases a day; one of them twice."""
    rows = []
    for day in range((last - first).days + 1):
        d = first + timedelta(days=day)
        rows += [
            (d, "e1", f"p{day % 5}", "c1", "r1", 1.0 + day % 3, 10.0 + day % 7),
            (d, "e2", "p9", None, "r2", 2.0, 20.0),
            (d, "e2", "p9", None, "r2", 2.0, 20.0),
        ]
    return spark.createDataFrame(rows, SCHEMA)


def test_weekly_features_of_a_full_week(spark):
    row = weekly.weekly_features(purchases(spark, MONDAY, MONDAY + timedelta(days=6)), ROLES).first()
    assert row["week_start"] == MONDAY
    assert row["purchase_record_count"] == 21
    assert (row["survey_response_diversity"], row["unique_product_code_count"]) == (2, 6)
    assert (row["unique_category_count"], row["unique_shipping_state_count"]) == (1, 2)
    assert row["missing_value_rate"] == pytest.approx(14 / (21 * 7) * 100)
    assert row["duplicate_rate"] == pytest.approx(7 / 21 * 100)


def test_digest_identity_and_sketches_give_the_same_small_result(spark):
    df = purchases(spark, MONDAY, MONDAY + timedelta(days=20))
    exact = weekly.weekly_features(df, ROLES).orderBy("week_start").collect()
    assert weekly.weekly_features(df, ROLES, identity="digest").orderBy("week_start").collect() == exact
    assert weekly.weekly_features(df, ROLES, approximate=True).orderBy("week_start").collect() == exact


def test_rows_without_a_date_are_dropped(spark):
    df = purchases(spark, MONDAY, MONDAY).unionByName(
        spark.createDataFrame([(None, "x", "x", "x", "x", 1.0, 1.0)], SCHEMA))
    assert weekly.weekly_features(df, ROLES).first()["purchase_record_count"] == 3


@pytest.mark.parametrize("first, last, notes", [
    (date(2022, 1, 1), date(2022, 1, 16), [
        "Partial source window: genuine 2022 data begins on 2022-01-01 after this calendar week began.", None, None]),
    (date(2022, 1, 3), date(2022, 1, 15), [
        None, "Partial source window: genuine 2022 data ends on 2022-01-15 before this calendar week is complete."]),
    (date(2022, 1, 4), date(2022, 1, 6), [
        "Partial source window: the 2022 source begins and ends before this calendar week is complete."]),
])
def test_partial_week_notes(spark, first, last, notes):
    features = weekly.weekly_features(purchases(spark, first, last), ROLES)
    rows = weekly.partial_weeks(features).orderBy("week_start").collect()
    assert [r["source_window_note"] for r in rows] == notes
    assert [r["is_partial_source_window"] for r in rows] == [n is not None for n in notes]


def test_partial_week_is_not_scored_on_volume_but_stays_in_the_baseline(spark):
    df = purchases(spark, date(2022, 1, 1), date(2022, 2, 8))
    rows = weekly_fingerprints(weekly_scores(df, ROLES)).orderBy("week").collect()
    cut = rows[-1]
    assert cut["is_partial_source_window"] and "purchase_record_count" not in cut["similarity_scored_features"]
    assert cut["excluded_from_similarity_features"][0]["feature"] == "purchase_record_count"
    assert "2022 source period" in cut["excluded_from_similarity_features"][0]["reason"]
    # Weeks of 6, 21, 21, 21, 21, 21 purchases come before the last one.
    assert cut["feature_comparison"]["purchase_record_count"]["baseline_mean"] == pytest.approx((6 + 5 * 21) / 6)
    assert rows[1]["excluded_from_similarity_features"] == []


def test_scores_look_only_backwards(spark):
    short = purchases(spark, MONDAY, MONDAY + timedelta(days=7 * 8 - 1))
    longer = short.unionByName(purchases(spark, MONDAY + timedelta(weeks=8), MONDAY + timedelta(days=7 * 11 - 1)))
    pick = lambda df: weekly_scores(df, ROLES).filter(
        F.col("week_start") < MONDAY + timedelta(weeks=8)
    ).select("week_start", "behavioral_similarity_score").orderBy("week_start").collect()
    assert pick(short) == pick(longer)


def test_score_bounds(spark, sf_dir):
    from workload.tables import DRIFT, ROLES as roles, purchases as table

    scores = weekly_scores(table(spark, sf_dir), roles, DRIFT)
    outside = scores.filter(~F.col("behavioral_similarity_score").between(0, 100)).count()
    assert outside == 0
