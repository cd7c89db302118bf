"""Dashboard queries over the scored panel and its gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import right_closed_band, rounded
from carepanel.operators.care_gaps import PRIORITIES, gap_count
from carepanel.operators.measures import at_least
from carepanel.operators.panel_risk import RISK_TIERS
from carepanel.operators.population_report import PREVALENCE, counts_over, diabetics, flag_shares

# Histogram edges and labels; bands are open below and closed above.
AGE_EDGES, AGE_BANDS = [18, 30, 45, 55, 65, 75, 95], ["18-29", "30-44", "45-54", "55-64", "65-74", "75+"]
HBA1C_EDGES = [4, 6, 7, 8, 9, 10, 11, 15]
HBA1C_BANDS = [f"({lo}, {hi}]" for lo, hi in zip(HBA1C_EDGES, HBA1C_EDGES[1:])]
SOCIAL_SERIES = {
    "Transportation": "transportation_barrier",
    "Food insecurity": "food_insecurity",
    "Housing": "housing_instability",
    "Social isolation": "social_isolation",
}
OUT_OF_RANGE = "out_of_range"


def headline(panel: DataFrame, measure_counts: DataFrame) -> DataFrame:
    """Panel size, very-high-risk share, open gaps and measures on target, in one row."""
    met = measure_counts.agg(
        F.struct(F.count_if(at_least(F.col("raw_rate"), F.col("target"))).alias("met"), F.count("*").alias("all"))
    ).scalar()
    counted = panel.select((F.col("risk_tier") == "VERY_HIGH").alias("top"), gap_count().alias("gaps")).agg(
        F.count("*").alias("attributed_patients"),
        F.count_if("top").alias("very_high"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("open_gaps"),
        F.count_if(F.col("gaps") > 0).alias("patients_with_gaps"),
    )

    def share(column: str):
        return rounded(F.try_divide(F.col(column).cast("double"), F.col("attributed_patients")) * 100, 1)

    return counted.select(
        "attributed_patients",
        "very_high",
        share("very_high").alias("very_high_pct"),
        "open_gaps",
        "patients_with_gaps",
        share("patients_with_gaps").alias("patients_with_gaps_pct"),
        met["met"].alias("measures_met"),
        met["all"].alias("measures"),
    )


def histogram(rows: DataFrame, column: str, edges: list[float], bands: list[str], keep_outside: bool = False) -> DataFrame:
    band = right_closed_band(column, edges, bands)
    if keep_outside:
        band, bands = F.coalesce(band, F.lit(OUT_OF_RANGE)), [*bands, OUT_OF_RANGE]
    return counts_over(rows.select(band.alias("band")), "band", bands).select("position", "band", "patients")


def age_histogram(panel: DataFrame, keep_outside: bool = False) -> DataFrame:
    """Six age bands. 18 itself falls below the first band, and 30 is in "18-29"."""
    return histogram(panel, "age", AGE_EDGES, AGE_BANDS, keep_outside)


def hba1c_histogram(panel: DataFrame, keep_outside: bool = False) -> DataFrame:
    return histogram(diabetics(panel), "hba1c", HBA1C_EDGES, HBA1C_BANDS, keep_outside)


def care_level_counts(panel: DataFrame) -> DataFrame:
    return panel.groupBy("care_management_level").agg(F.count("*").alias("patients"))


def tier_filter(panel: DataFrame, tiers: list[str] | None) -> DataFrame:
    return panel.where(F.col("risk_tier").isin(tiers)) if tiers else panel


def tier_series(panel: DataFrame) -> DataFrame:
    return counts_over(panel, "risk_tier", RISK_TIERS).select("position", "risk_tier", "patients")


def gap_priority_series(gaps: DataFrame) -> DataFrame:
    """Counts in fixed order; priorities without gaps are dropped."""
    counted = counts_over(gaps, "priority", PRIORITIES).where(F.col("patients") > 0)
    return counted.select("position", "priority", F.col("patients").alias("gaps"))


def frequent_gap_types(gaps: DataFrame, n: int = 8) -> DataFrame:
    counted = gaps.groupBy("gap_type").agg(F.count("*").alias("gaps"))
    return counted.orderBy(F.desc("gaps"), "gap_type").limit(n)


def prevalence_series(panel: DataFrame) -> DataFrame:
    return flag_shares(panel, PREVALENCE, "condition").select("condition", "pct").orderBy(F.desc("pct"), "condition")


def social_series(panel: DataFrame) -> DataFrame:
    return flag_shares(panel, SOCIAL_SERIES, "social_risk").select("social_risk", "patients")
