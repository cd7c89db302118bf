"""Pseudonyms and the allow-list that keeps PHI out of every output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.operators.patient_features import CONDITION_PREFIXES

PHI_COLUMNS = {"patient_id", "family_name", "given_name", "date_of_birth", "birth_date", "zip_code", "phone"}

# The 44 columns a de-identified patient row may hold.
SAFE_COLUMNS = [
    "patient_token", "age", "age_over_65", "age_over_80", "gender_female", "gender_male", "state",
    "num_active_conditions", "num_total_conditions", "high_comorbidity_burden",
    *[f"has_{name}" for name in CONDITION_PREFIXES],
    "hba1c_value", "hba1c_abnormal", "hba1c_poor_control", "creatinine_value", "creatinine_abnormal",
    "sodium_value", "sodium_low", "hemoglobin_value", "anemia_flag",
    "systolic_bp", "hypertensive_urgency", "bmi", "obese",
    "num_active_medications", "polypharmacy",
    "total_encounters_ever", "num_inpatient_encounters", "num_ed_encounters", "high_utilizer",
    "avg_length_of_stay", "long_stay_history",
    "uncontrolled_diabetes", "heart_failure_with_anemia", "num_abnormal_labs",
]


def pseudonym(patient_id: Column | str, salt: str = "") -> Column:
    """First 16 hex digits of SHA-256. Unsalted by default, so tokens match across runs."""
    value = F.col(patient_id) if isinstance(patient_id, str) else patient_id
    return F.substring(F.sha2(F.concat(F.lit(salt), value) if salt else value, 256), 1, 16)


def deidentify(features: DataFrame, salt: str = "", cap_age_90: bool = False) -> DataFrame:
    """Keep the allow-listed columns only; the real id becomes a token."""
    safe = features.withColumn("patient_token", pseudonym("patient_id", salt))
    if cap_age_90:
        safe = safe.withColumn("age", F.least("age", F.lit(90)))
    safe = safe.select(*SAFE_COLUMNS)
    leaked = PHI_COLUMNS.intersection(safe.columns)
    if leaked:
        raise ValueError(f"PHI columns in de-identified output: {sorted(leaked)}")
    return safe
