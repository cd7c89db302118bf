"""Rule-based 30-day care plans from a patient's tier and risk factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.arrays import to_rows

# Keyword in the factors -> category, action, priority. Earlier rules win their category.
RULES = [
    ("prior inpatient", "Transitional care",
     "Enroll in Transitional Care Management; nurse call within 48h of discharge", "High"),
    ("prior admissions", "Transitional care",
     "Assign a care coordinator for 30-day post-discharge monitoring", "High"),
    ("prior er", "Utilization",
     "Review ED utilization drivers; set up an ambulatory care access plan", "High"),
    ("insulin", "Diabetes management",
     "Diabetes educator review of insulin regimen; confirm glucometer + supplies", "High"),
    ("diabetes", "Diabetes management",
     "Reinforce diabetes self-management education and dietary counseling", "Medium"),
    ("hba1c", "Diabetes management",
     "Endocrinology follow-up for glycemic control; recheck HbA1c in 4-6 weeks", "Medium"),
    ("glucose", "Diabetes management",
     "Establish home glucose monitoring with logging and clinician review", "Medium"),
    ("diagnoses on record", "Complex care",
     "Complete medication reconciliation across all conditions", "High"),
    ("medications changed", "Medication safety",
     "Pharmacist review of medication changes; counsel on adherence", "High"),
    ("active medications", "Medication safety",
     "Assess polypharmacy risk; simplify regimen where possible", "Medium"),
    ("medications", "Medication safety",
     "Pharmacist-led medication reconciliation and adherence check", "Medium"),
    ("days in hospital", "Home support",
     "Order home health assessment given the prolonged length of stay", "Medium"),
    ("discharge disposition", "Care transitions",
     "Confirm discharge destination has adequate support and follow-up", "Medium"),
    ("primary diagnosis", "Disease-specific",
     "Coordinate specialist follow-up for the primary diagnosis", "Medium"),
    ("age", "Geriatric care",
     "Fall-risk and functional assessment; consider geriatric consult", "Medium"),
    ("procedures", "Post-procedure",
     "Post-procedure wound/recovery check and symptom education", "Low"),
]
FOLLOW_UP = ("Primary care", "Schedule PCP follow-up within 7 days of discharge")
ESCALATION = ("Escalation", "Flag for intensive case management; daily check-ins for the first week")
PRIORITIES = ["High", "Medium", "Low"]


def _step(order: int, category: str, action: str, priority: Column) -> Column:
    rank = F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), priority)
    return F.struct(
        F.when(rank > 0, rank).otherwise(len(PRIORITIES) + 1).alias("rank"),
        F.lit(order).alias("rule_order"),
        F.lit(category).alias("category"),
        F.lit(action).alias("action"),
        priority.alias("priority"),
    )


def interventions() -> Column:
    """Ordered interventions of a row with ``tier`` and ``top_3_risk_factors``.

    The rules are literals, so a plan is a narrow expression. A rule applies when its keyword occurs
    and no earlier rule of the same category has applied.
    """
    factors, tier = F.lower("top_3_risk_factors"), F.col("tier")
    found = {keyword: factors.contains(keyword) for keyword, *_ in RULES}
    steps = [F.when(tier == "High", _step(-1, *ESCALATION, F.lit("High")))]
    for i, (keyword, category, action, priority) in enumerate(RULES):
        applies = found[keyword]
        for earlier, other, *_ in RULES[:i]:
            if other == category:
                applies = applies & ~found[earlier]
        steps.append(F.when(applies, _step(i, category, action, F.lit(priority))))
    follow_up_priority = F.when(tier == "High", "High").otherwise("Medium")
    steps.append(_step(len(RULES), *FOLLOW_UP, follow_up_priority))
    return F.array_sort(F.filter(F.array(*steps), lambda s: s.isNotNull()))


def care_plans(scores: DataFrame) -> DataFrame:
    """One plan per patient: summary text and interventions by priority."""
    summary = F.concat(
        F.col("tier"), F.lit("-risk patient (score "), F.coalesce(F.col("risk_score").cast("string"), F.lit("NA")), F.lit("/100). Key drivers: "),
        F.col("top_3_risk_factors"),
        F.lit(". Plan targets the top modifiable readmission drivers with a structured 30-day transition."),
    )
    known = scores.withColumns(
        {
            "tier": F.coalesce("tier", F.lit("Medium")),
            "top_3_risk_factors": F.coalesce("top_3_risk_factors", F.lit("")),
        }
    )
    return known.select("patient_id", summary.alias("summary"), interventions().alias("interventions"))


def plan_steps(plans: DataFrame) -> DataFrame:
    """Long form of the plans, numbered from 1."""
    steps = to_rows(plans, F.col("interventions"), "patient_id", alias="s", position="pos")
    return steps.select(
        "patient_id", (F.col("pos") + 1).alias("step"), F.col("s.category"), F.col("s.action"), F.col("s.priority")
    )
