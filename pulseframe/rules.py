"""Thresholds, labels and message formats of the monitoring rules.

Every rule is a field of a frozen dataclass, so a caller can run the same plan with other limits
(``replace(HealthRules(), growth_pct=80.0)``). Nothing here touches Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------------------------------
# They must stay as they are for results to agree with the published monitoring rules.
# --------------------------------------------------------------------------------------------------

# The weekly behaviour features in ranking order (ties in a ranking follow this order) and their labels.
FEATURE_LABELS = {
    "purchase_record_count": "Purchase Record Count",
    "survey_response_diversity": "Survey Response Diversity",
    "unique_product_code_count": "Unique Product Code Count",
    "unique_category_count": "Unique Category Count",
    "unique_shipping_state_count": "Unique Shipping State Count",
    "average_quantity": "Average Quantity",
    "quantity_stddev": "Quantity Standard Deviation",
    "average_purchase_price_per_unit": "Average Purchase Price Per Unit",
    "purchase_price_per_unit_stddev": "Purchase Price Per Unit Standard Deviation",
    "missing_value_rate": "Missing-Value Rate",
    "duplicate_rate": "Duplicate-Row Rate",
}
VOLUME_FEATURE = "purchase_record_count"

# Drift status names.
BASELINE_BUILDING = "Baseline Building"
INSUFFICIENT_HISTORY = "Insufficient History"
NORMAL = "Normal"
MODERATE_DRIFT = "Moderate Drift"
MAJOR_DRIFT = "Major Drift"

# Alert types, id prefixes and severities from lowest to highest.
BEHAVIORAL_DRIFT = "Behavioral Drift"
DATA_HEALTH = "Data Health"
ALERT_ID_PREFIX = {BEHAVIORAL_DRIFT: "behavioral-", DATA_HEALTH: "data-health-"}
SEVERITIES = ("INFO / NORMAL", "WARNING", "HIGH", "CRITICAL")

# Partial-week notes; %s is the period name, then the boundary date.
NOTE_BOTH_ENDS = "Partial source window: the %s source begins and ends before this calendar week is complete."
NOTE_FIRST_WEEK = "Partial source window: genuine %s data begins on %s after this calendar week began."
NOTE_LAST_WEEK = "Partial source window: genuine %s data ends on %s before this calendar week is complete."
PARTIAL_WEEK_EXCLUSION = (
    "Excluded from similarity scoring because the genuine %s source period does not cover this full calendar week."
)

# Batch anomaly and deduction texts.
ANOMALY_MISSING = "High missing values in %s: %.2f%%"
ANOMALY_DUPLICATES = "High duplicate percentage: %.2f%%"
ANOMALY_GROWTH = "Abnormal batch-size change: %.2f%%"
ANOMALY_OUTLIERS = "High numerical outlier percentage in %s: %.2f%%"
ANOMALY_SCHEMA = "Schema drift detected."
DEDUCTION_LABELS = (
    "High missing values",
    "High duplicate percentage",
    "Abnormal batch-size change",
    "High numerical outliers",
    "Schema drift",
)
NO_SCHEMA_DRIFT = "No schema drift detected."

# Dataset report texts.
ISSUE_MISSING = "High missing-value rate detected: %.1f%%"
ISSUE_DUPLICATES = "Duplicate rows detected: %.1f%%"
ISSUE_OUTLIERS = "Outliers detected across numeric fields: %.1f%%"
ISSUE_UNUSABLE = "Dataset usability is limited: readable columns or valid rows are missing."
ISSUE_NONE = "No major data-health issues detected."
DATE_COLUMN_FOUND = (
    "Time-based data detected. Historical behavioral drift analysis may be possible for this dataset."
    " Candidate date/time column: %s."
)
DATE_NAME_TOKENS = ("date", "time", "timestamp")
NOT_A_CSV = "Please upload a valid .csv file."
CSV_UNREADABLE = "Unable to read the CSV file: %s"
REPORT_TYPE = "uploaded_dataset_health"
UNKNOWN_FILE = "Unknown"

# Alert texts.
BEHAVIOR_TRIGGER = "%s: behavioural similarity is %s/100. Top deviations: %s."
NO_TOP_FEATURES = "not available"
PARTIAL_WEEK_SUFFIX = (
    " %s Transaction volume is excluded from behavioural similarity scoring for this source-truncated week."
)
HEALTH_TRIGGER = "Implementation 1 Data Health Score is %d/100: %s"
NO_REASON = "No reason recorded"
CSV_NOT_ANALYSED = "Unable to analyze the CSV file: %s"
# Drift statuses, severity and sentence of the weekly screen.
WEEK_MESSAGES = (
    (
        (BASELINE_BUILDING, INSUFFICIENT_HISTORY), None,
        "Behavioral Similarity Score: N/A. Drift Status: Baseline Building. Four earlier weekly batches and valid feature"
        " statistics are required before scoring.",
    ),
    (
        (NORMAL,), "INFO / NORMAL",
        "Weekly purchase behaviour is consistent with the prior-only historical baseline.",
    ),
    (
        (MODERATE_DRIFT,), "WARNING",
        "Weekly purchase behaviour shows moderate drift from the prior-only historical baseline.",
    ),
    (
        (MAJOR_DRIFT,), "HIGH",
        "Weekly purchase behaviour shows major drift from the prior-only historical baseline.",
    ),
)
REASON_LIMIT = 105


# Fixed values, too: the default limits of all rules below.


@dataclass(frozen=True)
class HealthRules:
    """Limits and deductions of the per-batch health score."""

    missing_column_pct: float = 20.0
    duplicate_pct: float = 3.0
    growth_pct: float = 50.0
    outlier_pct: float = 3.0
    missing_deduction: int = 15
    duplicate_deduction: int = 15
    growth_deduction: int = 20
    outlier_deduction: int = 15
    schema_deduction: int = 25
    healthy_from: int = 90
    warning_from: int = 70
    fence_width: float = 1.5
    quartile_accuracy: int = 10000
    exact_quartiles: bool = False


@dataclass(frozen=True)
class DriftRules:
    """Limits of the weekly drift comparison. ``null_feature`` decides what a NULL feature scores against a
    zero-variance baseline: ``"max"`` gives the largest z-score, ``"skip"`` leaves it unscored."""

    min_history_weeks: int = 4
    zero_variance_epsilon: float = 1e-9
    max_z: float = 5.0
    points_per_z: float = 20.0
    normal_from: float = 80.0
    moderate_from: float = 55.0
    top_features: int = 3
    null_feature: str = "max"
    period: str = "2022"


@dataclass(frozen=True)
class DatasetRules:
    """Penalty tiers of the dataset report: each pair is (highest percentage, penalty); beyond the last pair the
    final penalty applies."""

    missing_tiers: tuple = ((1, 0), (5, 10), (15, 20))
    missing_worst: int = 30
    duplicate_tiers: tuple = ((1, 0), (5, 10), (15, 20))
    duplicate_worst: int = 30
    outlier_tiers: tuple = ((2, 0), (5, 5), (10, 10))
    outlier_worst: int = 20
    unusable_penalty: int = 10
    healthy_from: int = 80
    warning_from: int = 50
    min_outlier_values: int = 4
    fence_width: float = 1.5
    quartile_accuracy: int = 10000
    exact_quartiles: bool = False


@dataclass(frozen=True)
class AlertRules:
    critical_below: float = 35.0
    active_year: str = "2022"


@dataclass(frozen=True)
class Roles:
    """Which source column plays which part in the purchase monitoring plans."""

    date: str = "Order Date"
    entity: str = "Survey ResponseID"
    product: str = "ASIN/ISBN (Product Code)"
    category: str = "Category"
    region: str = "Shipping Address State"
    quantity: str = "Quantity"
    price: str = "Purchase Price Per Unit"

    @property
    def numeric(self) -> list[str]:
        return [self.quantity, self.price]
