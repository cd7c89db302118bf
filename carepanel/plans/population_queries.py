"""Registered queries over the population panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepanel.operators import care_gaps as cg
from carepanel.operators import measures as ms
from carepanel.operators import panel_risk as pr
from carepanel.operators import panel_views as pv
from carepanel.operators import population_report as rep
from carepanel.plans.population_job import scored_panel
from carepanel.sources import sinks
from carepanel.sources.fixture_views import view


def _derived(spark, d):
    return pr.derive_panel_columns(view(spark, d, "population"))


def _panel(spark, d):
    return scored_panel(view(spark, d, "population"))


def _gaps(spark, d):
    return cg.care_gaps(_panel(spark, d))


def _counts(spark, d):
    return ms.measure_counts(_derived(spark, d))


def derived_columns(spark, d):
    return _derived(spark, d).select(
        "patient_token", "num_conditions", "sdoh_risk_score", "statin_eligible", "statin_prescribed", "statin_gap"
    )


def components(spark, d):
    return pr.component_scores(_derived(spark, d)).select(
        "patient_token",
        *[F.col(c).cast("double").alias(c) for c in ("condition_score", "utilization_score", "clinical_score", "social_score")],
    )


def risk(spark, d):
    return _panel(spark, d).select(
        "patient_token", "risk_score_raw", "risk_score", "risk_tier", "predicted_cost_tier", "care_management_level"
    )


def gap_rows(spark, d):
    return _gaps(spark, d).drop("gap_order")


def worklist_from_gaps(spark, d):
    panel = _panel(spark, d)
    return cg.worklist_from_gaps(panel, cg.care_gaps(panel), 100)


def snapshot(spark, d):
    panel = _panel(spark, d)
    snap = sinks.population_snapshot(panel, rep.gap_totals(panel), ms.measure_table(ms.measure_counts(panel)), "2024-04-01")
    return snap.select(
        "generated_at",
        "population_size",
        F.col("risk_tier_counts")["LOW"].alias("low"),
        F.col("risk_tier_counts")["MODERATE"].alias("moderate"),
        "total_care_gaps",
        "patients_with_gaps",
        F.size("hedis_measures").alias("measure_records"),
        F.aggregate("hedis_measures", F.lit(0.0), lambda a, m: a + m["rate"]).alias("rate_sum"),
    )


def filtered_panel(spark, d):
    chosen = pv.tier_filter(_panel(spark, d), ["HIGH", "VERY_HIGH"])
    return chosen.select("patient_token", "risk_tier", "risk_score")


QUERIES = {
    "c01_derived_columns": derived_columns,
    "c02_c05_component_scores": components,
    "c06_c09_risk_tiers": risk,
    "c10_c19_c21_measure_table": lambda s, d: ms.measure_table(_counts(s, d)),
    "c20_gap_patients": lambda s, d: ms.gap_patients(_derived(s, d)),
    "c22_measure_status": lambda s, d: ms.measure_status(_counts(s, d)),
    "c23_c35_care_gaps": gap_rows,
    "c36_gap_summary": lambda s, d: cg.gap_summary(_gaps(s, d)),
    "c36_c38_daily_worklist": lambda s, d: cg.daily_worklist(_panel(s, d)),
    "c37_worklist_from_gap_table": worklist_from_gaps,
    "c39_tier_distribution": lambda s, d: rep.tier_distribution(_panel(s, d)),
    "c40_disease_prevalence": lambda s, d: rep.disease_prevalence(view(s, d, "population")),
    "c41_gap_totals": lambda s, d: rep.gap_totals(_derived(s, d)),
    "c41_gap_priority_shares": lambda s, d: rep.gap_priority_shares(_gaps(s, d)),
    "c42_top_gap_types": lambda s, d: rep.top_gap_types(_derived(s, d), _gaps(s, d)),
    "c43_social_prevalence": lambda s, d: rep.social_prevalence(_derived(s, d)),
    "c44_financial_impact": lambda s, d: rep.financial_impact(_derived(s, d), _counts(s, d)),
    "c45_engagement": lambda s, d: rep.engagement(view(s, d, "population")),
    "c45_contact_preferences": lambda s, d: rep.contact_preferences(view(s, d, "population")),
    "c46_glycemic_bands": lambda s, d: rep.glycemic_bands(view(s, d, "population")),
    "c47_hba1c_statistics": lambda s, d: rep.hba1c_statistics(view(s, d, "population")),
    "c48_diabetic_comorbidity": lambda s, d: rep.diabetic_comorbidity(view(s, d, "population")),
    "c49_diabetic_adherence": lambda s, d: rep.diabetic_adherence(view(s, d, "population")),
    "c50_critical_diabetics": lambda s, d: rep.critical_diabetics(_panel(s, d)),
    "c51_intervention_targets": lambda s, d: rep.intervention_targets(view(s, d, "population")),
    "c52_closure_projection": lambda s, d: ms.closure_projection(_counts(s, d)),
    "c53_program_return": lambda s, d: rep.program_return(view(s, d, "population")),
    "c55_json_snapshot": snapshot,
    "c56_headline": lambda s, d: pv.headline(_panel(s, d), _counts(s, d)),
    "c57_age_histogram": lambda s, d: pv.age_histogram(view(s, d, "population")),
    "c58_hba1c_histogram": lambda s, d: pv.hba1c_histogram(view(s, d, "population")),
    "c59_care_levels": lambda s, d: pv.care_level_counts(_panel(s, d)),
    "c60_tier_filter": filtered_panel,
    "c60_gap_explorer": lambda s, d: cg.explore_gaps(_gaps(s, d), ["CRITICAL", "HIGH"]),
    "c61_gap_priority_series": lambda s, d: pv.gap_priority_series(_gaps(s, d)),
    "c61_frequent_gap_types": lambda s, d: pv.frequent_gap_types(_gaps(s, d)),
    "c62_tier_series": lambda s, d: pv.tier_series(_panel(s, d)),
    "c62_prevalence_series": lambda s, d: pv.prevalence_series(view(s, d, "population")),
    "c62_social_series": lambda s, d: pv.social_series(view(s, d, "population")),
    "c63_status_view": lambda s, d: ms.status_view(_counts(s, d)),
    "c63_rate_vs_target": lambda s, d: ms.rate_vs_target(_counts(s, d)),
}
