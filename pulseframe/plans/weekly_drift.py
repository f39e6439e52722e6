"""Weekly behavioural drift from fact rows to nested fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseframe import rules
from pulseframe.operators.weekly import WEEK, compare_to_history, weekly_drift, weekly_features
from pulseframe.rules import DriftRules, Roles

FINGERPRINT_FIELDS = [
    "week", "is_partial_source_window", "source_window_note", "historical_observations", "baseline_ready",
    "similarity_scored_feature_count", "similarity_scored_features", "excluded_from_similarity_features",
    "behavioral_features", "feature_comparison", "behavioral_similarity_score", "drift_status",
    "top_deviating_features",
]


def weekly_scores(
    df: DataFrame, roles: Roles = Roles(), limits: DriftRules = DriftRules(), *,
    approximate: bool = False, identity: str = "digest", daily: DataFrame | None = None,
) -> DataFrame:
    """Fact rows to one scored row per week, in a single lazy plan."""
    features = weekly_features(df, roles, approximate=approximate, identity=identity, daily=daily)
    return weekly_drift(compare_to_history(features, limits), limits)


def weekly_fingerprints(scores: DataFrame, limits: DriftRules = DriftRules()) -> DataFrame:
    """The nested weekly record, ready for the JSON sink and for the alert rules."""
    feature_map = lambda value: F.map_from_entries(
        F.transform("features", lambda f: F.struct(f["feature"], value(f)))
    )
    comparison = lambda f: F.struct(*[
        f[n].alias(n) for n in ("current", "baseline_mean", "baseline_stddev", "z_score")
    ])
    left_out = F.array(F.struct(
        F.lit(rules.VOLUME_FEATURE).alias("feature"),
        F.lit(rules.PARTIAL_WEEK_EXCLUSION % limits.period).alias("reason"),
    ))
    scored = F.transform(
        F.filter("features", lambda f: f["z_score"].isNotNull()), lambda f: f["feature"]
    )
    derived = {
        "week": F.date_format(WEEK, "yyyy-MM-dd"),
        "similarity_scored_features": scored,
        "excluded_from_similarity_features": F.when(
            F.col("is_partial_source_window"), left_out).otherwise(F.slice(left_out, 1, 0)),
        "behavioral_features": feature_map(lambda f: f["current"]),
        "feature_comparison": feature_map(comparison),
    }
    return scores.select(*[derived[f].alias(f) if f in derived else F.col(f) for f in FINGERPRINT_FIELDS])
