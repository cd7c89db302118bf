"""Data-quality report of the patient feature table. Each report is one pass over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from carepanel.functions.numeric import rounded
from carepanel.functions.quantiles import exact_quantile

# Reported features with their pass and warn limits in percent.
COMPLETENESS = {
    "critical": (["age", "num_active_conditions", "num_inpatient_encounters", "num_ed_encounters"], 90, 70),
    "lab": (["hba1c_value", "creatinine_value", "sodium_value", "hemoglobin_value", "systolic_bp"], 70, 40),
}
RISK_FLAGS = ["high_utilizer", "high_comorbidity_burden", "uncontrolled_diabetes"]


def unfold(summary: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per reported item."""
    structs = [F.struct(*[v.alias(n) for v, n in zip(row, names)]) for row in rows]
    return summary.select(F.inline(F.array(*structs)))


def completeness(features: DataFrame) -> DataFrame:
    names = [(group, c, ok, warn) for group, (cols, ok, warn) in COMPLETENESS.items() for c in cols if c in features.columns]
    counted = features.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for _, c, _, _ in names])

    def grade(pct: Column, ok: int, warn: int) -> Column:
        return F.when(pct >= ok, "pass").when(pct >= warn, "warn").otherwise("fail")

    rows = []
    for group, c, ok, warn in names:
        pct = rounded(F.try_divide(F.col(c) * 100.0, F.col("total")), 1)
        rows.append([F.lit(group), F.lit(c), F.col(c), F.col("total"), pct, grade(pct, ok, warn)])
    return unfold(counted, rows, ["feature_group", "feature", "non_null", "total", "pct_complete", "grade"])


def validity(features: DataFrame) -> DataFrame:
    age, hba1c = F.col("age"), F.col("hba1c_value")
    rules = {
        "age_outside_0_120": (age < 0) | (age > 120),
        "hba1c_outside_3_20": (hba1c < 3) | (hba1c > 20),
        "negative_inpatient_count": F.col("num_inpatient_encounters") < 0,
    }
    counted = features.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    rows = [[F.lit(name), F.col(name), F.col(name) == 0] for name in rules]
    return unfold(counted, rows, ["rule", "violations", "passed"])


def distribution(features: DataFrame) -> DataFrame:
    """Mean, exact median (by distributed selection, no task holds all values), least and greatest age; condition counts."""
    median = exact_quantile(features, "age", 0.5)
    return features.agg(
        F.avg("age").alias("age_mean"),
        F.lit(median).cast("double").alias("age_median"),
        F.min("age").alias("age_min"),
        F.max("age").alias("age_max"),
        F.avg("num_active_conditions").alias("active_conditions_mean"),
        F.max("num_active_conditions").alias("active_conditions_max"),
    )


def prevalence(features: DataFrame) -> DataFrame:
    """Share of patients per ``has_*`` column, in percent."""
    cols = [c for c in features.columns if c.startswith("has_")]
    shares = features.agg(*[F.coalesce(F.avg(c) * 100, F.lit(0.0)).alias(c) for c in cols])
    rows = [[F.lit(c.removeprefix("has_")), F.col(c)] for c in cols]
    return unfold(shares, rows, ["condition", "prevalence_pct"])


def risk_indicators(features: DataFrame) -> DataFrame:
    cols = [c for c in RISK_FLAGS if c in features.columns]
    counted = features.agg(F.count("*").alias("total"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    rows = [[F.lit(c), F.col(c), F.try_divide(F.col(c) * 100.0, F.col("total"))] for c in cols]
    return unfold(counted, rows, ["indicator", "patients", "pct_of_total"])
