"""Per-patient clinical features: one aggregate per child table, then left joins on patient_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepanel.functions.numeric import any_true, flag, rounded, sure_flag

# LOINC codes of the laboratory and vital-sign features.
LOINC_CODES = {
    "hba1c": "4548-4",
    "glucose": "2345-7",
    "creatinine": "2160-0",
    "sodium": "2951-2",
    "hemoglobin": "718-7",
    "systolic_bp": "8480-6",
    "diastolic_bp": "8462-4",
    "heart_rate": "8867-4",
    "bmi": "39156-5",
}

# ICD-10 prefixes of the high-risk condition groups.
CONDITION_PREFIXES = {
    "diabetes": ["E10", "E11", "E13"],
    "heart_failure": ["I50"],
    "copd": ["J44", "J43"],
    "ckd": ["N18"],
    "hypertension": ["I10", "I11", "I12", "I13"],
    "coronary_artery_disease": ["I25"],
    "atrial_fibrillation": ["I48"],
    "depression": ["F32", "F33"],
    "cancer": ["C"],
    "stroke": ["I63", "I64"],
}

# Encounter class codes.
INPATIENT_CLASSES = ["IMP", "INPATIENT", "I"]
EMERGENCY_CLASSES = ["EMER", "EMERGENCY", "ED", "E"]

FEATURE_LABS = ["hba1c", "creatinine", "sodium", "hemoglobin", "systolic_bp", "bmi"]


def demographic_flags(patients: DataFrame) -> DataFrame:
    return patients.withColumns(
        {
            "gender_female": flag(F.col("gender") == "female"),
            "gender_male": flag(F.col("gender") == "male"),
            "age_over_65": flag(F.col("age") >= 65),
            "age_over_80": flag(F.col("age") >= 80),
        }
    )


def condition_features(conditions: DataFrame) -> DataFrame:
    """Burden counts and one flag per high-risk group, over codes of any clinical status."""
    is_active = F.col("clinical_status").isin("active", "Active")
    groups = [
        sure_flag(F.bool_or(any_true([F.col("code").startswith(p) for p in prefixes]))).alias(f"has_{name}")
        for name, prefixes in CONDITION_PREFIXES.items()
    ]
    return conditions.groupBy("patient_id").agg(
        F.count_if(is_active).cast("int").alias("num_active_conditions"),
        F.count("*").cast("int").alias("num_total_conditions"),
        *groups,
    )


def latest_lab_values(observations: DataFrame, tie_col: str = "seq", labs: list[str] | None = None) -> DataFrame:
    """Latest usable value of each lab, one row per patient.

    The date is compared as text; on a tie the earliest row of the feed wins. All labs come out of a
    single aggregate, so no pivot shuffle is needed.
    """
    tie = observations.schema[tie_col].dataType
    parts = [f"{tie_col}.{name}" for name in tie.names] if isinstance(tie, T.StructType) else [tie_col]
    newest = F.struct(F.col("effective_date"), *[F.bitwise_not(part).alias(f"order_{i}") for i, part in enumerate(parts)])
    reading = F.struct("value_text", "value_num", "interpretation", "effective_date")

    def latest(lab: str) -> Column:
        is_lab = F.col("loinc_code") == LOINC_CODES[lab]
        return F.max_by(F.when(is_lab, reading), F.when(is_lab, newest)).alias(lab)

    usable = observations.where(F.col("value_text").isNotNull() & (F.col("effective_date") != ""))
    return usable.groupBy("patient_id").agg(*[latest(lab) for lab in labs or FEATURE_LABS])


def lab_flags(latest: DataFrame) -> DataFrame:
    """Values and flags of the latest readings. An absent interpretation or number leaves a null."""

    def marked(lab: str, mark: str) -> Column:
        interp = F.col(lab)["interpretation"]
        return F.when(interp != "", flag(interp == mark))

    def number(lab: str) -> Column:
        return F.col(lab)["value_num"]

    return latest.select(
        "patient_id",
        number("hba1c").alias("hba1c_value"),
        marked("hba1c", "H").alias("hba1c_abnormal"),
        flag(number("hba1c") > 8.0).alias("hba1c_poor_control"),
        number("creatinine").alias("creatinine_value"),
        marked("creatinine", "H").alias("creatinine_abnormal"),
        number("sodium").alias("sodium_value"),
        marked("sodium", "L").alias("sodium_low"),
        number("hemoglobin").alias("hemoglobin_value"),
        marked("hemoglobin", "L").alias("anemia_flag"),
        number("systolic_bp").alias("systolic_bp"),
        flag(number("systolic_bp") >= 180).alias("hypertensive_urgency"),
        number("bmi").alias("bmi"),
        flag(number("bmi") >= 30).alias("obese"),
    )


def encounter_features(encounters: DataFrame) -> DataFrame:
    class_code = F.upper("class_code")
    inpatient = class_code.isin(INPATIENT_CLASSES)
    stay = F.when(inpatient, F.col("length_of_stay_days"))
    return encounters.groupBy("patient_id").agg(
        F.count("*").cast("int").alias("total_encounters_ever"),
        F.count_if(inpatient).cast("int").alias("num_inpatient_encounters"),
        F.count_if(class_code.isin(EMERGENCY_CLASSES)).cast("int").alias("num_ed_encounters"),
        rounded(F.avg(stay), 1).alias("avg_length_of_stay"),
        flag(F.bool_or(stay > 7)).alias("long_stay_history"),
    )


COUNT_COLUMNS = [
    "num_active_conditions",
    "num_total_conditions",
    *[f"has_{name}" for name in CONDITION_PREFIXES],
    "num_active_medications",
    "total_encounters_ever",
    "num_inpatient_encounters",
    "num_ed_encounters",
]


def assemble_patients(
    patients: DataFrame, conditions: DataFrame, labs: DataFrame, medications: DataFrame, encounters: DataFrame
) -> DataFrame:
    """Left joins of the per-patient aggregates; absent counts are 0, absent measurements stay null.

    Every side is already grouped by patient_id, so each join reuses that partitioning and only the
    patient table itself is shuffled again.
    """
    joined = patients
    for side in (conditions, labs, medications, encounters):
        joined = joined.join(side, "patient_id", "left")
    return joined.fillna(0, COUNT_COLUMNS)


def burden_flags(features: DataFrame) -> DataFrame:
    return features.withColumns(
        {
            "high_comorbidity_burden": flag(F.col("num_active_conditions") >= 3),
            "polypharmacy": flag(F.col("num_active_medications") >= 5),
            "high_utilizer": flag(F.col("num_inpatient_encounters") >= 3),
        }
    )


ABNORMAL_LAB_FLAGS = ["hba1c_abnormal", "creatinine_abnormal", "sodium_low", "anemia_flag"]


def composite_flags(features: DataFrame) -> DataFrame:
    def both(base: str, lab: str) -> Column:
        return F.when(F.col(lab).isNotNull(), sure_flag((F.col(base) == 1) & (F.col(lab) == 1)))

    abnormal = sum((sure_flag(F.col(c) == 1) for c in ABNORMAL_LAB_FLAGS), F.lit(0))
    return features.withColumns(
        {
            "uncontrolled_diabetes": both("has_diabetes", "hba1c_poor_control"),
            "heart_failure_with_anemia": both("has_heart_failure", "anemia_flag"),
            "num_abnormal_labs": abnormal,
        }
    )
