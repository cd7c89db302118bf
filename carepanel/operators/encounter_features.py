"""Model features of cleaned encounters, and the explorative counts around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import plain_number, rounded, sure_flag
from carepanel.functions.text import let, strip
from carepanel.operators.cleaning import ENCOUNTER, PATIENT, TARGET
from carepanel.operators.quality import unfold
from carepanel.sources.schemas import MEDICATION_COLUMNS

# The feature contract.
NUMERIC_FEATURES = [
    "age_midpoint", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "num_chronic_conditions",
    "num_prior_admissions", "num_meds_changed", "num_meds_on", "change_flag", "diabetes_med_flag",
]
CATEGORICAL_FEATURES = [
    "race", "gender", "medical_specialty_grp", "admission_type_grp", "admission_source_grp",
    "discharge_disposition_grp", "diag_1_group", "diag_2_group", "diag_3_group", "a1c_result",
    "max_glu_serum_grp", "insulin",
]
ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# ICD-9 groups in order of precedence, as whole-code ranges (low, high).
ICD9_GROUPS = [
    ("Circulatory", [(390, 459), (785, 785)]),
    ("Respiratory", [(460, 519), (786, 786)]),
    ("Digestive", [(520, 579), (787, 787)]),
    ("Injury", [(800, 999)]),
    ("Musculoskeletal", [(710, 739)]),
    ("Genitourinary", [(580, 629), (788, 788)]),
    ("Neoplasm", [(140, 239)]),
]

# Administrative codes by group.
ADMISSION_TYPES = {"Emergency": [1], "Urgent": [2], "Elective": [3], "Newborn": [4], "Trauma": [7], "Unknown": [5, 6, 8]}
ADMISSION_SOURCES = {
    "Physician Referral": [1],
    "Clinic Referral": [2],
    "HMO Referral": [3],
    "Transfer": [4, 5, 6, 10, 18, 22, 25],
    "Emergency Room": [7],
    "Birth": [11, 12, 13, 14],
}
DISCHARGES = {
    "Home": [1],
    "Home Health": [6, 8],
    "Transferred Facility": [2, 3, 4, 5, 22, 23, 24],
    "AMA": [7],
}
RARE_SHARE = 0.01


def icd9_group(code: Column) -> Column:
    """Disease group of an ICD-9 code."""
    return let(strip(code), lambda text: let(plain_number(text), lambda number: _icd9_group(text, number)))


def _icd9_group(text: Column, number: Column) -> Column:
    whole = F.floor(number)
    group = (
        F.when(text.isNull() | (text == "") | (F.lower(text) == "nan"), "Missing")
        .when(text.startswith("V"), "Other")
        .when(text.startswith("E"), "Injury")
        .when(number.isNull(), "Other")
        .when((number >= 250) & (number < 251), "Diabetes")
    )
    for name, ranges in ICD9_GROUPS:
        group = group.when(reduce(lambda a, b: a | b, [whole.between(lo, hi) for lo, hi in ranges]), name)
    return group.otherwise("Other")


def code_group(code: Column, groups: dict[str, list[int]]) -> Column:
    """Group of an administrative code; null is Unknown, a code outside the map is Other."""
    group = F.when(code.isNull(), "Unknown")
    for name, codes in groups.items():
        group = group.when(code.isin(codes), name)
    return group.otherwise("Other")


def add_utilization(df: DataFrame) -> DataFrame:
    prior = [F.coalesce(F.col(c), F.lit(0)) for c in ("number_inpatient", "number_emergency", "number_outpatient")]
    return df.withColumns(
        {"num_prior_admissions": prior[0] + prior[1] + prior[2], "num_chronic_conditions": F.col("number_diagnoses")}
    )


def add_diagnosis_groups(df: DataFrame) -> DataFrame:
    grouped = {
        f"{c}_group": icd9_group(F.col(c)) if c in df.columns else F.lit("Missing") for c in ("diag_1", "diag_2", "diag_3")
    }
    return df.withColumns(grouped)


def add_admin_groups(df: DataFrame) -> DataFrame:
    maps = {
        "admission_type": ("admission_type_id", ADMISSION_TYPES),
        "admission_source": ("admission_source_id", ADMISSION_SOURCES),
        "discharge_disposition": ("discharge_disposition_id", DISCHARGES),
    }
    added = {f"{out}_grp": code_group(F.col(src), m) for out, (src, m) in maps.items() if src in df.columns}
    return df.withColumns(added) if added else df


def add_lab_levels(df: DataFrame) -> DataFrame:
    """Lab results as levels; a test that was not done is its own level ``None``."""
    sources = {"a1c_result": "A1Cresult", "max_glu_serum_grp": "max_glu_serum"}
    added = {out: F.coalesce(F.col(src), F.lit("None")) for out, src in sources.items() if src in df.columns}
    return df.withColumns(added) if added else df


def add_medication_churn(df: DataFrame) -> DataFrame:
    """How many of the present drug columns were adjusted, and how many are in use."""
    drugs = [F.coalesce(F.col(f"`{c}`"), F.lit("No")) for c in MEDICATION_COLUMNS if c in df.columns]
    count = lambda test: sum((sure_flag(test(d)) for d in drugs), F.lit(0))
    return df.withColumns(
        {"num_meds_changed": count(lambda d: d.isin("Up", "Down")), "num_meds_on": count(lambda d: d != "No")}
    )


def frequent_levels(df: DataFrame, column: str, min_share: float = RARE_SHARE) -> DataFrame:
    """Levels (null included) holding at least ``min_share`` of the rows: never more than 1/min_share rows."""
    if min_share <= 0:
        raise ValueError("min_share must be positive, as it bounds how many levels there can be")
    levels = df.groupBy(F.col(column).alias("_level")).agg(F.count("*").alias("_n"))
    total = levels.agg(F.sum("_n")).scalar()
    return levels.where(F.col("_n") / total >= min_share).select("_level", F.lit(True).alias("_kept"))


def collapse_rare(df: DataFrame, column: str, min_share: float = RARE_SHARE) -> DataFrame:
    """Rare levels become Other.

    Only the frequent levels are joined back; at most 1/min_share of them can exist, so broadcasting
    that side is safe however many rare levels the data has.
    """
    kept = F.broadcast(frequent_levels(df, column, min_share))
    joined = df.join(kept, F.col(column).eqNullSafe(F.col("_level")), "left")
    return joined.withColumn(column, F.when(F.col("_kept"), F.col(column)).otherwise("Other")).drop("_level", "_kept")


def known_or_unknown(column: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("Unknown"))


def normalize_categories(df: DataFrame) -> DataFrame:
    return df.withColumns({c: known_or_unknown(c) for c in ("race", "gender", "insulin") if c in df.columns})


def with_all_features(cleaned: DataFrame) -> DataFrame:
    steps = [add_utilization, add_diagnosis_groups, add_admin_groups, add_lab_levels, add_medication_churn]
    df = reduce(lambda acc, step: step(acc), steps, cleaned)
    df = collapse_rare(df, "medical_specialty")
    df = df.withColumn("medical_specialty_grp", known_or_unknown("medical_specialty"))
    return normalize_categories(df)


def build_features(cleaned: DataFrame) -> DataFrame:
    """Ids, target and the 26 contracted features."""
    df = with_all_features(cleaned)
    missing = [c for c in ALL_FEATURES if c not in df.columns]
    if missing:
        raise ValueError(f"features missing from the input: {missing}")
    numeric = [F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]
    return df.select(PATIENT, ENCOUNTER, TARGET, *numeric, *CATEGORICAL_FEATURES)


def class_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("readmitted").agg(F.count("*").alias("encounters"))


def positive_rate(raw: DataFrame) -> DataFrame:
    return raw.agg(rounded(F.avg(sure_flag(F.col("readmitted") == "<30")) * 100, 2).alias("positive_rate_pct"))


def missing_shares(df: DataFrame) -> DataFrame:
    """Share of nulls per column, for columns that have any, most missing first."""
    shares = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns])
    rows = [[F.lit(c), rounded(F.col(f"`{c}`") * 100, 2)] for c in df.columns]
    return unfold(shares, rows, ["column_name", "missing_pct"]).where("missing_pct > 0").orderBy(F.desc("missing_pct"), "column_name")


def diagnosis_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("diag_1_group").agg(F.count("*").alias("patients"))


def score_histogram(scores: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width bins of the score within each tier's own range; the top edge is in the last bin.

    Grouping by the integer score first leaves at most 101 rows per tier for the range lookup.
    """
    by_score = scores.groupBy("tier", "risk_score").agg(F.count("*").alias("_n"))
    tier = Window.partitionBy("tier")
    lo, hi = F.min("risk_score").over(tier), F.max("risk_score").over(tier)
    flat = hi == lo
    width = F.when(flat, F.lit(1.0)).otherwise((hi - lo).cast("double"))
    start = F.when(flat, lo - 0.5).otherwise(lo.cast("double"))
    index = F.least(F.floor((F.col("risk_score") - start) * bins / width), F.lit(bins - 1))
    return by_score.withColumn("bin", index).groupBy("tier", "bin").agg(F.sum("_n").alias("patients"))
