"""Composite risk score, tiers and care-management level of an attributed panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import clamp, right_closed_band, rounded, sure_flag, weighted_sum

# Points of the chronic conditions, and the bonus for three or more.
CONDITION_POINTS = {
    "has_heart_disease": 12,
    "has_diabetes": 10,
    "has_copd": 10,
    "has_ckd": 8,
    "has_cancer_history": 6,
    "has_hypertension": 4,
    "has_depression": 4,
}
MANY_CONDITIONS, MANY_CONDITIONS_POINTS = 3, 6

PANEL_CONDITIONS = [
    "has_diabetes", "has_hypertension", "has_heart_disease", "has_copd", "has_ckd", "has_cancer_history", "has_depression",
]
SOCIAL_RISKS = ["transportation_barrier", "food_insecurity", "housing_instability", "social_isolation"]

# Tier bands of the 0-100 score, lowest first.
RISK_EDGES, RISK_TIERS = [0, 20, 40, 65, 100], ["LOW", "MODERATE", "HIGH", "VERY_HIGH"]
COST_EDGES, COST_TIERS = [0, 25, 50, 75, 100], ["Tier1_Low", "Tier2_Med", "Tier3_High", "Tier4_Critical"]
CARE_LEVELS = {
    "VERY_HIGH": "Intensive Case Management",
    "HIGH": "Care Management",
    "MODERATE": "Disease Management Program",
    "LOW": "Standard Preventive Care",
}

YEAR = 365
ADHERENT_PDC = 0.80


def _has(condition: str) -> Column:
    return F.col(condition) == 1


def derive_panel_columns(panel: DataFrame) -> DataFrame:
    """Condition count, statin eligibility and gap, and the number of social risks."""
    total = lambda cols: sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    eligible = _has("has_heart_disease") | (_has("has_diabetes") & (F.col("age") >= 40))
    return (
        panel.withColumn("num_conditions", total(PANEL_CONDITIONS))
        .withColumn("sdoh_risk_score", total(SOCIAL_RISKS))
        .withColumn("statin_eligible", sure_flag(eligible))
        .withColumn("statin_prescribed", F.col("statin_eligible") * F.col("statin_flag"))
        .withColumn("statin_gap", F.col("statin_eligible") - F.col("statin_prescribed"))
        .drop("statin_flag")
    )


def condition_score() -> Column:
    terms = [(F.col(c), points) for c, points in CONDITION_POINTS.items()]
    many = sure_flag(F.col("num_conditions") >= MANY_CONDITIONS)
    return clamp(weighted_sum([*terms, (many, MANY_CONDITIONS_POINTS)]), 0, 40)


def utilization_score() -> Column:
    lost = sure_flag(F.col("last_pcp_visit_days") > YEAR)
    return clamp(weighted_sum([(F.col("inpatient_admits_12m"), 10), (F.col("ed_visits_12m"), 5), (lost, 8)]), 0, 30)


def clinical_score() -> Column:
    hba1c, systolic = F.col("hba1c"), F.col("systolic_bp")
    diabetic, hypertensive = _has("has_diabetes"), _has("has_hypertension")
    points = [
        (diabetic & (hba1c > 9.0), 8),
        (diabetic & (hba1c > 8.0) & (hba1c <= 9.0), 4),
        (hypertensive & (systolic > 150), 6),
        (hypertensive & (systolic > 140) & (systolic <= 150), 3),
        (F.col("statin_gap") == 1, 4),
        (diabetic & (F.col("diabetes_med_pdc") < ADHERENT_PDC), 4),
        (hypertensive & (F.col("htn_med_pdc") < ADHERENT_PDC), 4),
    ]
    return clamp(weighted_sum([(sure_flag(c), p) for c, p in points]), 0, 20)


def social_score() -> Column:
    return clamp(F.col("sdoh_risk_score") * 2.5, 0, 10)


def component_scores(panel: DataFrame) -> DataFrame:
    return panel.withColumns(
        {
            "condition_score": condition_score(),
            "utilization_score": utilization_score(),
            "clinical_score": clinical_score(),
            "social_score": social_score(),
        }
    )


RAW_SCORE_PARTS = ["condition_score", "utilization_score", "clinical_score", "social_score"]


def add_panel_risk(panel: DataFrame) -> DataFrame:
    """Score relative to the highest raw score of the panel, then tiers.

    The maximum is a scalar subquery: one aggregate over the few score inputs whose single value is
    handed to the main scan. There is no join and no window over the whole panel.
    """
    raw = sum((F.col(c) for c in RAW_SCORE_PARTS[1:]), F.col(RAW_SCORE_PARTS[0])).cast("double")
    scored = component_scores(panel).withColumn("risk_score_raw", raw).drop(*RAW_SCORE_PARTS)
    highest = scored.agg(F.max("risk_score_raw")).scalar()
    scored = scored.withColumn("risk_score", rounded(F.try_divide(F.col("risk_score_raw"), highest) * 100, 1))
    levels = F.create_map(*[F.lit(x) for pair in CARE_LEVELS.items() for x in pair])
    return (
        scored.withColumn("risk_tier", right_closed_band("risk_score", RISK_EDGES, RISK_TIERS, include_lowest=True))
        .withColumn("predicted_cost_tier", right_closed_band("risk_score", COST_EDGES, COST_TIERS, include_lowest=True))
        .withColumn(
            "care_management_level",
            F.coalesce(F.try_element_at(levels, F.col("risk_tier")), F.lit(CARE_LEVELS["LOW"])),
        )
    )
