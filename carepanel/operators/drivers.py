"""Which features push a patient's risk up or down, for linear models.

A linear model's score is a sum over features, so each patient's contributions are plain column
arithmetic on that patient's own row: no matrix, no explode and no shuffle. Levels of one category
are summed into their base feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import rounded
from carepanel.operators.encounter_features import NUMERIC_FEATURES
from carepanel.operators.quality import unfold

# Display names of the features.
FRIENDLY_NAMES = {
    "num_prior_admissions": "prior admissions",
    "number_inpatient": "prior inpatient visits",
    "number_emergency": "prior ER visits",
    "number_outpatient": "prior outpatient visits",
    "num_chronic_conditions": "diagnoses on record",
    "time_in_hospital": "days in hospital",
    "num_medications": "medications",
    "num_lab_procedures": "lab procedures",
    "num_procedures": "procedures",
    "age_midpoint": "age",
    "num_meds_changed": "medications changed",
    "num_meds_on": "active medications",
    "change_flag": "medication changed this stay",
    "diabetes_med_flag": "on diabetes medication",
    "diag_1_group": "primary diagnosis",
    "diag_2_group": "secondary diagnosis",
    "diag_3_group": "additional diagnosis",
    "admission_type_grp": "admission type",
    "admission_source_grp": "admission source",
    "discharge_disposition_grp": "discharge disposition",
    "a1c_result": "HbA1c",
    "max_glu_serum_grp": "glucose serum",
    "insulin": "insulin",
    "race": "race",
    "gender": "gender",
    "medical_specialty_grp": "specialty",
}
NO_FACTORS = "no elevated risk factors"


@dataclass(frozen=True)
class LinearTerm:
    """``weight * (x - center)``; x is a number, or 1 when a category holds ``level`` else 0.

    ``fill`` replaces a missing number. Terms come from a fitted model (``modeling.linear_terms``) or
    from any published linear score.
    """

    feature: str
    weight: float
    center: float
    level: str | None = None
    fill: float | None = None


def friendly(feature: str) -> str:
    return FRIENDLY_NAMES.get(feature, feature.replace("_", " "))


def base_features(terms: list[LinearTerm]) -> list[str]:
    return list(dict.fromkeys(t.feature for t in terms))


def contribution(feature: str, terms: list[LinearTerm]) -> Column:
    """Summed contribution of one base feature."""
    mine = [t for t in terms if t.feature == feature]
    total = F.lit(0.0)
    for t in (t for t in mine if t.level is None):
        x = F.col(feature).cast("double")
        total = total + F.lit(t.weight) * ((x if t.fill is None else F.coalesce(x, F.lit(t.fill))) - F.lit(t.center))
    levels = [t for t in mine if t.level is not None]
    if levels:
        weights = F.create_map(*[F.lit(v) for t in levels for v in (t.level, t.weight)])
        average = sum(t.weight * t.center for t in levels)
        total = total + F.coalesce(F.try_element_at(weights, F.col(feature)), F.lit(0.0)) - F.lit(average)
    return total


def readable_value(feature: str, numeric: set[str] | None = None) -> Column:
    x = F.col(feature)
    if feature not in (numeric or set(NUMERIC_FEATURES)):
        return x.cast("string")
    x = x.cast("double")
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(rounded(x, 1).cast("string"))


def readable_factor(feature: str) -> Column:
    """``label: value`` with the patient's own value, or the label alone when it is missing."""
    label = F.lit(friendly(feature))
    return F.coalesce(F.concat(label, F.lit(": "), readable_value(feature)), label)


def with_contributions(features: DataFrame, terms: list[LinearTerm]) -> DataFrame:
    """Adds ``contributions``: one struct per base feature, in term order."""
    items = [
        F.struct(
            F.lit(f).alias("feature"), contribution(f, terms).alias("value"), readable_factor(f).alias("phrase"),
            readable_value(f).alias("patient_value"),
        )
        for f in base_features(terms)
    ]
    return features.withColumn("contributions", F.array(*items))


def contribution_rows(explained: DataFrame, id_col: str) -> DataFrame:
    """Long form of the contributions: patient, base feature, value."""
    return explained.select(id_col, F.inline("contributions")).select(id_col, "feature", F.col("value").alias("contribution"))


def top_phrases(k: int = 3) -> Column:
    """The k largest positive contributions of a row as one phrase."""
    positive = F.filter("contributions", lambda c: c["value"] > 0)
    ranked = F.array_sort(
        F.transform(positive, lambda c, i: F.struct((-c["value"]).alias("order"), i.alias("i"), c["phrase"].alias("phrase")))
    )
    phrases = F.array_join(F.transform(F.slice(ranked, 1, k), lambda c: c["phrase"]), "; ")
    return F.when(F.size(positive) > 0, phrases).otherwise(NO_FACTORS)


def top_factors(explained: DataFrame, id_col: str, k: int = 3) -> DataFrame:
    """The k largest positive contributions as one phrase per patient."""
    return explained.select(id_col, top_phrases(k).alias("top_3_risk_factors"))


def global_importance(explained: DataFrame, terms: list[LinearTerm], top_n: int = 12) -> DataFrame:
    """Mean absolute contribution per base feature as a share of the total, largest first.

    One aggregate with a column per feature; the contributions are never exploded.
    """
    names = base_features(terms)
    size = lambda i: F.avg(F.abs(F.get("contributions", F.lit(i))["value"])).alias(f"m{i}")
    means = explained.agg(*[size(i) for i in range(len(names))])
    total = sum((F.col(f"m{i}") for i in range(1, len(names))), F.col("m0"))
    total = F.when(total == 0, 1.0).otherwise(total)
    rows = [[F.lit(n), F.lit(friendly(n)), F.col(f"m{i}") / total * 100] for i, n in enumerate(names)]
    table = unfold(means, rows, ["feature", "label", "relative_influence"])
    return table.orderBy(F.desc("relative_influence"), "feature").limit(top_n)


def patient_drivers(explained: DataFrame, id_col: str, patient: int, top_n: int = 8) -> DataFrame:
    """One patient's largest contributions in either direction."""
    one = explained.where(F.col(id_col) == patient).select(F.inline("contributions"))
    names = F.create_map(*[F.lit(x) for pair in FRIENDLY_NAMES.items() for x in pair])
    label = F.coalesce(F.try_element_at(names, F.col("feature")), F.replace(F.col("feature"), F.lit("_"), F.lit(" ")))
    ranked = one.orderBy(F.desc(F.abs("value")), "feature").limit(top_n)
    return ranked.select("feature", label.alias("label"), F.col("value").alias("contribution"), "patient_value")
