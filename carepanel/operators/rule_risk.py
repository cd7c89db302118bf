"""Additive rule score of the patient feature table and its tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import right_closed_band, weighted_sum

# Points per event with a ceiling, and points per flag or count.
CAPPED_POINTS = {"num_inpatient_encounters": (15, 30), "num_ed_encounters": (5, 15)}
FLAT_POINTS = {
    "high_comorbidity_burden": 10,
    "has_heart_failure": 15,
    "has_copd": 10,
    "has_ckd": 10,
    "uncontrolled_diabetes": 12,
    "polypharmacy": 8,
    "num_abnormal_labs": 8,
    "age_over_80": 10,
    "age_over_65": 5,
}
SCORE_CAP = 100
TIER_EDGES, TIER_LABELS = [0, 30, 60, 100], ["LOW", "MEDIUM", "HIGH"]

SAMPLE_COLUMNS = [
    "patient_token", "age", "gender_female", "num_active_conditions", "has_diabetes",
    "hba1c_value", "num_inpatient_encounters", "high_utilizer", "high_comorbidity_burden",
]
TOP_COLUMNS = [
    "patient_token", "risk_score", "risk_tier", "num_inpatient_encounters", "has_heart_failure", "num_abnormal_labs",
]


def rule_score() -> Column:
    """Points of a row, capped; an unknown input adds nothing."""
    known = lambda c: F.coalesce(F.col(c), F.lit(0))
    capped = [(F.least(known(c) * points, F.lit(top)), 1) for c, (points, top) in CAPPED_POINTS.items()]
    flat = [(known(c), points) for c, points in FLAT_POINTS.items()]
    return F.least(weighted_sum(capped + flat), F.lit(SCORE_CAP)).cast("int")


def add_rule_risk(features: DataFrame) -> DataFrame:
    return features.withColumn("risk_score", rule_score()).withColumn(
        "risk_tier", right_closed_band("risk_score", TIER_EDGES, TIER_LABELS, include_lowest=True)
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier").agg(F.count("*").alias("patients"))


def highest_risk(scored: DataFrame, n: int = 3) -> DataFrame:
    return scored.select(*TOP_COLUMNS).orderBy(F.desc("risk_score"), "patient_token").limit(n)


def sample_rows(features: DataFrame, n: int = 3) -> DataFrame:
    """First rows (by token) of those illustrative columns that exist."""
    return features.select(*[c for c in SAMPLE_COLUMNS if c in features.columns]).orderBy("patient_token").limit(n)
