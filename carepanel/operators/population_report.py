"""Population report, diabetes cohort and programme economics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import right_closed_band, rounded
from carepanel.functions.quantiles import exact_quantile
from carepanel.operators.care_gaps import PRIORITIES, gap_count, gap_count_of
from carepanel.operators.measures import MEDICARE
from carepanel.operators.panel_risk import ADHERENT_PDC, RISK_TIERS, YEAR
from carepanel.operators.quality import unfold

# Reported names and their columns.
PREVALENCE = {
    "Hypertension": "has_hypertension",
    "Diabetes": "has_diabetes",
    "Heart Disease": "has_heart_disease",
    "COPD": "has_copd",
    "CKD": "has_ckd",
    "Depression": "has_depression",
}
SOCIAL = {
    "Transportation barriers": "transportation_barrier",
    "Food insecurity": "food_insecurity",
    "Housing instability": "housing_instability",
    "Social isolation": "social_isolation",
}
COMORBIDITY = {
    "Also have Hypertension": "has_hypertension",
    "Also have Heart Disease": "has_heart_disease",
    "Also have CKD": "has_ckd",
    "Also have Depression": "has_depression",
}
GLYCEMIC_EDGES = [0, 7.0, 8.0, 9.0, 20]
GLYCEMIC_BANDS = ["Well Controlled (<7)", "Controlled (7-8)", "Suboptimal (8-9)", "Poor Control (>9)"]

# Programme economics.
STAR_VALUE_PER_MEMBER = 450
AVOIDED_SHARE = {"CRITICAL": 0.30, "HIGH": 0.15}
COST_PER_ADMISSION = 18_000
DIABETES_SHARE, DIABETES_COST, DIABETES_EFFECT = 0.15, 12_000, 0.30
PROGRAM_COST = 250_000


def counts_over(rows: DataFrame, key: str, domain: list[str]) -> DataFrame:
    """Rows per value of a closed domain, zero-filled, in one aggregate row unfolded to a table."""
    counted = rows.agg(
        F.count("*").alias("total"), *[F.count_if(F.col(key) == v).alias(f"n{i}") for i, v in enumerate(domain)]
    )
    out = [[F.lit(i), F.lit(v), F.col(f"n{i}"), F.col("total")] for i, v in enumerate(domain)]
    return unfold(counted, out, ["position", key, "patients", "total"])


def share_of_total(counted: DataFrame, key: str) -> DataFrame:
    share = rounded(F.try_divide(F.col("patients").cast("double"), F.col("total")) * 100, 1)
    return counted.select("position", key, "patients", share.alias("pct"))


def tier_distribution(panel: DataFrame) -> DataFrame:
    """Patients per tier with their share, highest tier first, empty tiers included."""
    return share_of_total(counts_over(panel, "risk_tier", RISK_TIERS[::-1]), "risk_tier")


def flag_shares(rows: DataFrame, named: dict[str, str], name: str) -> DataFrame:
    """Count and percentage of several 0/1 columns in one pass."""
    summed = rows.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"n_{c}") for c in named.values()],
        *[F.avg(c).alias(f"p_{c}") for c in named.values()],
    )
    out = [[F.lit(label), F.col(f"n_{c}"), rounded(F.col(f"p_{c}") * 100, 1)] for label, c in named.items()]
    return unfold(summed, out, [name, "patients", "pct"])


def disease_prevalence(panel: DataFrame) -> DataFrame:
    return flag_shares(panel, PREVALENCE, "condition")


def social_prevalence(panel: DataFrame) -> DataFrame:
    high = panel.withColumn("_high", (F.col("sdoh_risk_score") >= 2).cast("int"))
    return flag_shares(high, {**SOCIAL, "High SDOH risk (2+ factors)": "_high"}, "social_risk")


def gap_load(panel: DataFrame) -> DataFrame:
    """Panel size, open gaps and patients with gaps, counted on the panel rows themselves.

    Counting distinct patients on the exploded gap table would shuffle every gap; here nothing moves
    but one partial count per task.
    """
    n = F.col("_gaps")
    return panel.select(gap_count().alias("_gaps")).agg(
        F.count("*").alias("panel_size"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_gaps"),
        F.count_if(n > 0).alias("patients_with_gaps"),
    )


def gap_totals(panel: DataFrame) -> DataFrame:
    """Open gaps, patients with gaps, their share of the panel and gaps per patient."""
    n = F.col("patients_with_gaps")
    return gap_load(panel).select(
        "total_gaps",
        n,
        rounded(F.try_divide(n.cast("double"), F.col("panel_size")) * 100, 1).alias("pct_of_population"),
        rounded(F.try_divide(F.col("total_gaps").cast("double"), n), 1).alias("gaps_per_patient"),
    )


def gap_priority_shares(gaps: DataFrame) -> DataFrame:
    counted = counts_over(gaps, "priority", PRIORITIES[:3]).withColumnRenamed("patients", "gaps")
    share = rounded(F.try_divide(F.col("gaps").cast("double"), F.col("total")) * 100, 1)
    return counted.select("priority", "gaps", share.alias("pct"))


def top_gap_types(panel: DataFrame, gaps: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent gap types, as a share of patients with any gap."""
    with_gaps = gap_load(panel).select("patients_with_gaps").scalar()
    counted = gaps.groupBy("gap_type").agg(F.count("*").alias("patients"))
    share = rounded(F.try_divide(F.col("patients").cast("double"), with_gaps) * 100, 1)
    ranked = counted.orderBy(F.desc("patients"), "gap_type").limit(n)
    return ranked.select("gap_type", "patients", share.alias("pct_of_patients_with_gaps"))


def financial_impact(panel: DataFrame, measure_counts: DataFrame) -> DataFrame:
    """Distance to quality targets, value of better ratings and admissions avoided by closing gaps."""
    shortfall = F.when(~F.col("lower_is_better"), F.greatest(F.lit(0.0), F.col("target") - F.col("raw_rate")))
    to_target = measure_counts.agg(F.try_divide(F.sum(shortfall), F.count("*"))).scalar()
    counted = panel.agg(
        F.count_if(F.col("insurance").isin(MEDICARE)).alias("medicare_members"),
        *[F.coalesce(F.sum(gap_count_of(p)), F.lit(0)).alias(p) for p in AVOIDED_SHARE],
    )
    avoided = sum((F.col(p) * share for p, share in AVOIDED_SHARE.items()), F.lit(0.0))
    return counted.select(
        rounded(to_target, 1).alias("mean_gap_to_target_pp"),
        "medicare_members",
        (F.col("medicare_members") * STAR_VALUE_PER_MEMBER).alias("star_improvement_value"),
        F.col("CRITICAL").alias("critical_gaps"),
        F.col("HIGH").alias("high_gaps"),
        rounded(avoided, 2).alias("avoided_admissions"),
        rounded(avoided * COST_PER_ADMISSION, 0).alias("avoided_cost"),
    )


def engagement(panel: DataFrame) -> DataFrame:
    lost = F.col("last_pcp_visit_days") > YEAR
    return panel.agg(
        rounded(F.avg("mychart_enrolled") * 100, 1).alias("portal_enrollment_pct"),
        F.count_if(lost).alias("lost_to_followup"),
        rounded(F.avg(lost.cast("int")) * 100, 1).alias("lost_to_followup_pct"),
    )


def contact_preferences(panel: DataFrame) -> DataFrame:
    size = panel.agg(F.count("*")).scalar()
    counted = panel.groupBy("contact_preference").agg(F.count("*").alias("patients"))
    return counted.withColumn("pct", rounded(F.try_divide(F.col("patients").cast("double"), size) * 100, 1))


def diabetics(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("has_diabetes") == 1)


def glycemic_bands(panel: DataFrame) -> DataFrame:
    banded = diabetics(panel).withColumn("glycemic_control", right_closed_band("hba1c", GLYCEMIC_EDGES, GLYCEMIC_BANDS))
    return share_of_total(counts_over(banded, "glycemic_control", GLYCEMIC_BANDS), "glycemic_control")


def hba1c_statistics(panel: DataFrame) -> DataFrame:
    """Counts, mean, exact median (distributed selection) and shares above 8 and 9 of the diabetics' HbA1c."""
    above = {8: F.col("hba1c") > 8.0, 9: F.col("hba1c") > 9.0}
    median = exact_quantile(diabetics(panel), "hba1c", 0.5)
    return diabetics(panel).agg(
        F.count("*").alias("diabetic_patients"),
        rounded(F.avg("hba1c"), 1).alias("mean_hba1c"),
        rounded(F.lit(median).cast("double"), 1).alias("median_hba1c"),
        *[F.count_if(c).alias(f"above_{k}") for k, c in above.items()],
        *[rounded(F.avg(c.cast("int")) * 100, 1).alias(f"above_{k}_pct") for k, c in above.items()],
    )


def diabetic_comorbidity(panel: DataFrame) -> DataFrame:
    return flag_shares(diabetics(panel), COMORBIDITY, "comorbidity")


def diabetic_adherence(panel: DataFrame) -> DataFrame:
    late = F.col("diabetes_med_pdc") < ADHERENT_PDC
    return diabetics(panel).agg(
        rounded(F.avg("diabetes_med_pdc"), 2).alias("mean_pdc"),
        F.count_if(late).alias("non_adherent"),
        rounded(F.avg(late.cast("int")) * 100, 1).alias("non_adherent_pct"),
    )


def critical_diabetics(panel: DataFrame) -> DataFrame:
    critical = (F.col("hba1c") > 9.0) & (F.col("days_since_hba1c") <= YEAR)
    return diabetics(panel).where(critical).agg(
        F.count("*").alias("patients"),
        rounded(F.avg("hba1c"), 1).alias("mean_hba1c"),
        rounded(F.avg("risk_score"), 1).alias("mean_risk_score"),
    )


def intervention_targets(panel: DataFrame) -> DataFrame:
    hba1c = F.col("hba1c")
    return diabetics(panel).agg(
        F.count_if(hba1c > 9.0).alias("priority_1_above_9"),
        F.count_if((hba1c > 8.0) & (hba1c <= 9.0)).alias("priority_2_8_to_9"),
        F.count_if(F.col("diabetes_med_pdc") < ADHERENT_PDC).alias("priority_3_non_adherent"),
        F.count_if(F.col("days_since_hba1c") > YEAR).alias("priority_4_overdue"),
    )


def program_return(panel: DataFrame) -> DataFrame:
    """Yearly value of an outreach programme against its cost."""
    star = F.count_if(F.col("insurance").isin(MEDICARE)) * STAR_VALUE_PER_MEMBER * 0.5
    diabetes = F.coalesce(F.sum("has_diabetes"), F.lit(0)) * DIABETES_SHARE * DIABETES_COST * DIABETES_EFFECT
    valued = panel.agg(star.alias("star_bonus"), diabetes.alias("diabetes_savings"))
    total = F.col("star_bonus") + F.col("diabetes_savings")
    return valued.select(
        rounded("star_bonus", 2).alias("star_bonus"),
        rounded("diabetes_savings", 2).alias("diabetes_savings"),
        rounded(total, 2).alias("total_impact"),
        rounded(total - PROGRAM_COST, 2).alias("net_return"),
        rounded(total / PROGRAM_COST, 1).alias("return_ratio"),
    )
