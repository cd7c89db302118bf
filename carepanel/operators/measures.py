"""Quality measures over the panel: all ten come out of one aggregate over one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.arrays import to_rows
from carepanel.functions.numeric import rounded
from carepanel.functions.text import compact
from carepanel.operators.panel_risk import ADHERENT_PDC, YEAR
from carepanel.operators.quality import unfold

MEDICARE = ["Medicare", "Medicare_Advantage"]


@dataclass(frozen=True)
class Measure:
    """A quality measure: who counts, who meets it, who is a gap, and its benchmarks."""

    measure_id: str
    name: str
    eligible: Column
    met: Column
    gap: Column
    national_average: float
    target: float
    lower_is_better: bool = False


def measures() -> list[Measure]:
    """Measure definitions. Ids, names, averages and targets are fixed values."""
    c = F.col
    diabetic, hypertensive = c("has_diabetes") == 1, c("has_hypertension") == 1
    tested = diabetic & (c("days_since_hba1c") <= YEAR)
    colorectal_age = c("age").between(45, 75)
    breast_age = (c("gender") == "F") & c("age").between(50, 74)
    bp_ok = (c("systolic_bp") < 140) & (c("diastolic_bp") < 90)
    return [
        Measure("CDC_HbA1c_Testing", "Comprehensive Diabetes Care — HbA1c Testing",
                diabetic, c("days_since_hba1c") <= YEAR, c("days_since_hba1c") > YEAR, 88.0, 90.0),
        Measure("CDC_HbA1c_Control", "Comprehensive Diabetes Care — HbA1c Control (<8.0%)",
                tested, c("hba1c") < 8.0, c("hba1c") >= 8.0, 58.0, 65.0),
        Measure("CDC_Poor_HbA1c_Control", "Comprehensive Diabetes Care — Poor HbA1c Control (>9.0%)",
                tested, c("hba1c") > 9.0, c("hba1c") > 9.0, 21.0, 18.0, lower_is_better=True),
        Measure("CBP_Blood_Pressure_Control", "Controlling High Blood Pressure (<140/90)",
                hypertensive, bp_ok, (c("systolic_bp") >= 140) | (c("diastolic_bp") >= 90), 62.0, 70.0),
        Measure("COL_Colorectal_Screening", "Colorectal Cancer Screening",
                colorectal_age, c("colonoscopy_due") == 0, c("colonoscopy_due") == 1, 68.0, 75.0),
        Measure("BCS_Breast_Cancer_Screening", "Breast Cancer Screening (Mammogram)",
                breast_age, c("mammogram_due") == 0, c("mammogram_due") == 1, 72.0, 78.0),
        Measure("SPC_Statin_Cardiovascular", "Statin Use in Cardiovascular Disease",
                c("statin_eligible") == 1, c("statin_prescribed") == 1, c("statin_prescribed") == 0, 78.0, 85.0),
        Measure("MAD_Diabetes_Adherence", "Medication Adherence — Diabetes Medications (PDC≥80%)",
                diabetic, c("diabetes_med_pdc") >= ADHERENT_PDC, c("diabetes_med_pdc") < ADHERENT_PDC, 83.0, 87.0),
        Measure("MAH_Hypertension_Adherence", "Medication Adherence — Hypertension (PDC≥80%)",
                hypertensive, c("htn_med_pdc") >= ADHERENT_PDC, c("htn_med_pdc") < ADHERENT_PDC, 81.0, 86.0),
        Measure("AWV_Annual_Wellness", "Annual Wellness Visit Completion (Medicare)",
                c("insurance").isin(MEDICARE), c("awv_completed") == 1, c("awv_completed") == 0, 52.0, 65.0),
    ]


def measure_counts(panel: DataFrame) -> DataFrame:
    """Unrounded measure results, one row per measure."""
    defs = measures()
    counted = panel.agg(
        *[F.count_if(m.eligible).alias(f"den_{i}") for i, m in enumerate(defs)],
        *[F.count_if(m.eligible & m.met).alias(f"num_{i}") for i, m in enumerate(defs)],
        *[F.count_if(m.eligible & m.gap).alias(f"gap_{i}") for i, m in enumerate(defs)],
    )
    rows = [
        [
            F.lit(i), F.lit(m.measure_id), F.lit(m.name), F.col(f"den_{i}"), F.col(f"num_{i}"), F.col(f"gap_{i}"),
            F.coalesce(F.try_divide(F.col(f"num_{i}").cast("double"), F.col(f"den_{i}")) * 100, F.lit(0.0)),
            F.lit(m.national_average), F.lit(m.target), F.lit(m.lower_is_better),
        ]
        for i, m in enumerate(defs)
    ]
    names = [
        "measure_order", "measure_id", "measure_name", "denominator", "numerator", "gap_patient_count",
        "raw_rate", "national_average", "target", "lower_is_better",
    ]
    return unfold(counted, rows, names)


def at_least(rate: Column, limit: Column) -> Column:
    """Whether a rate reaches a limit in the measure's own direction."""
    return F.when(F.col("lower_is_better"), rate <= limit).otherwise(rate >= limit)


def measure_table(counts: DataFrame) -> DataFrame:
    rate = F.col("raw_rate")
    return counts.select(
        "measure_id",
        "measure_name",
        "denominator",
        "numerator",
        rounded(rate, 1).alias("rate"),
        "national_average",
        "target",
        "lower_is_better",
        rounded(F.col("target") - rate, 1).alias("gap_to_target"),
        at_least(rate, F.col("target")).alias("meets_target"),
        "gap_patient_count",
    )


def measure_status(counts: DataFrame) -> DataFrame:
    """PASS on target, NEAR when at least the national average, else FAIL."""
    rate = F.col("raw_rate")
    status = (
        F.when(at_least(rate, F.col("target")), "PASS")
        .when(at_least(rate, F.col("national_average")), "NEAR")
        .otherwise("FAIL")
    )
    return counts.select("measure_id", rounded(rate, 1).alias("rate"), "national_average", "target", status.alias("status"))


def gap_patients(panel: DataFrame) -> DataFrame:
    """Long (measure_id, patient_token) table of open gaps; a narrow step without a shuffle."""
    hits = compact([F.when(m.eligible & m.gap, F.lit(m.measure_id)) for m in measures()])
    return to_rows(panel, hits, "patient_token", alias="measure_id").select("measure_id", "patient_token")


def closure_projection(counts: DataFrame, effectiveness: float = 0.45, share_contacted: float = 0.30) -> DataFrame:
    """Rate per measure if outreach closes part of the open gaps; measures without gaps are left out."""
    closed = F.floor(F.col("gap_patient_count") * effectiveness * share_contacted)
    new_rate = F.least((F.col("numerator") + closed).cast("double") / F.col("denominator") * 100, F.lit(99.0))
    return counts.where((F.col("denominator") > 0) & (F.col("gap_patient_count") > 0)).select(
        "measure_id",
        "lower_is_better",
        closed.alias("patients_closed"),
        rounded("raw_rate", 1).alias("current_rate"),
        rounded(new_rate, 1).alias("projected_rate"),
        rounded(new_rate - F.col("raw_rate"), 1).alias("gain_pp"),
    )


def status_view(counts: DataFrame) -> DataFrame:
    """Dashboard table of the measures with a two-way status."""
    label = F.when(F.col("meets_target"), "Meets target").otherwise("Below target")
    return measure_table(counts).select(
        F.col("measure_name").alias("measure"),
        F.col("denominator").alias("denom"),
        F.col("numerator").alias("numer"),
        F.col("rate").alias("rate_pct"),
        F.col("national_average").alias("natl_avg_pct"),
        F.col("target").alias("target_pct"),
        "gap_to_target",
        label.alias("status"),
    )


def rate_vs_target(counts: DataFrame) -> DataFrame:
    return measure_table(counts).select("measure_id", "rate", "target", "national_average")
