"""Registered queries over hospital encounters, scores and outreach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.operators import bi_export, care_plan, cleaning, curves, drivers, fairness, outreach, scoring
from carepanel.operators import encounter_features as ef
from carepanel.operators.drivers import LinearTerm
from carepanel.sources.contact_log import upsert_contacts, usable_contacts
from carepanel.sources.encounters import coerce_numbers
from carepanel.sources.fixture_views import sql_over, view

AS_OF = "2024-04-01"

# A fixed linear score, so that drivers can be checked without fitting a model.
TERMS = [
    LinearTerm("number_inpatient", 0.31, 2.0),
    LinearTerm("num_prior_admissions", 0.12, 4.5),
    LinearTerm("time_in_hospital", 0.05, 7.5),
    LinearTerm("age_midpoint", 0.01, 50.0, fill=50.0),
    LinearTerm("num_medications", -0.02, 30.0),
    LinearTerm("diag_1_group", 0.4, 0.125, level="Diabetes"),
    LinearTerm("diag_1_group", 0.25, 0.125, level="Circulatory"),
    LinearTerm("diag_1_group", -0.2, 0.25, level="Injury"),
    LinearTerm("insulin", 0.15, 0.25, level="Up"),
    LinearTerm("insulin", 0.07, 0.25, level="Down"),
]

RAW_TEXT = """
SELECT CASE WHEN l_partkey % 3 = 0 THEN CAST(9007199254740993 + l_orderkey AS STRING) WHEN l_partkey % 3 = 1 THEN concat(' ', CAST(l_orderkey AS STRING), '.0 ')
            ELSE CAST(l_orderkey AS STRING) END AS encounter_id,
       CASE WHEN l_partkey % 11 = 0 THEN concat(CAST(o_custkey AS STRING), '.') ELSE CAST(o_custkey AS STRING) END AS patient_nbr, o_orderstatus AS readmitted,
       CASE WHEN l_suppkey % 9 = 1 THEN '5d' WHEN l_suppkey % 9 = 2 THEN '0x1p3' WHEN l_suppkey % 9 = 3 THEN 'NaN' WHEN l_suppkey % 9 = 4 THEN 'Infinity' WHEN l_suppkey % 9 = 5 THEN ' 7 '
            WHEN l_suppkey % 9 = 6 THEN '1e400' WHEN l_suppkey % 9 = 7 THEN '-.5E1' ELSE 'x' END AS num_procedures,
       CASE l_linenumber WHEN 1 THEN '?' WHEN 2 THEN '' WHEN 3 THEN concat(' ', CAST(l_partkey AS STRING)) ELSE CAST(l_quantity AS STRING) END AS number_inpatient,
       CASE WHEN l_partkey % 7 = 0 THEN '12x' ELSE CAST(l_suppkey AS STRING) END AS num_medications
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

ICD_TEXT = """
SELECT l_orderkey AS k, l_linenumber AS n,
       CASE l_partkey % 12 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'V45' WHEN 3 THEN 'E812' WHEN 4 THEN 'abc' WHEN 5 THEN 'nan'
            WHEN 6 THEN concat('250.', CAST(l_suppkey % 100 AS STRING)) WHEN 7 THEN concat(' ', CAST(100 + l_partkey % 900 AS STRING), ' ')
            ELSE concat(CAST(l_orderkey % 1000 AS STRING), '.', CAST(l_suppkey % 10 AS STRING)) END AS code
FROM {lineitem} l
"""


def _cleaned(spark, d) -> DataFrame:
    return cleaning.clean(view(spark, d, "admissions"))


def _features(spark, d) -> DataFrame:
    return ef.build_features(_cleaned(spark, d))


def _scores(spark, d) -> DataFrame:
    return scoring.score_frame(view(spark, d, "scores"))


def _log(spark, d) -> DataFrame:
    return usable_contacts(view(spark, d, "contact_log"))


def _status(spark, d) -> DataFrame:
    return outreach.contact_status(_scores(spark, d), _log(spark, d), AS_OF)


def _sweep(spark, d) -> DataFrame:
    return curves.sweep(view(spark, d, "scores"))


def _explained(spark, d) -> DataFrame:
    return drivers.with_contributions(_features(spark, d), TERMS)


def _models(spark, d) -> DataFrame:
    """Two models over the same patients: the given probability and a flattened one."""
    base = view(spark, d, "scores").select("probability", "y_true")
    flat = base.withColumn("probability", F.col("probability") * F.col("probability") / 2 + 0.25)
    metrics = [
        curves.evaluate(m).withColumns({"model": F.lit(name), "model_order": F.lit(i)})
        for i, (name, m) in enumerate((("logreg", base), ("gbm", flat)))
    ]
    return metrics[0].unionByName(metrics[1])


def _document(spark, d) -> DataFrame:
    size = view(spark, d, "scores").agg(F.count("*").alias("n_rows"), F.round(F.avg("y_true"), 4).alias("positive_rate"))
    models = _models(spark, d)
    return bi_export.metrics_document(models, curves.champion(models), size)


def _audit(spark, d) -> DataFrame:
    features = _features(spark, d)
    return fairness.audit_frame(features, _scores(spark, d), cleaning.PATIENT, cleaning.TARGET)


def _subgroups(spark, d) -> DataFrame:
    return fairness.subgroup_metrics(_audit(spark, d), fairness.ATTRIBUTES)


def _subgroups_of_scores(spark, d) -> DataFrame:
    scored = _scores(spark, d).withColumn("y_pred", F.col("predicted_label"))
    return fairness.subgroup_metrics(scored.withColumnRenamed("subgroup", "segment"), ["segment"])


def numeric_coercion(spark, d):
    return coerce_numbers(sql_over(spark, d, RAW_TEXT))


def cleaned_rows(spark, d):
    return _cleaned(spark, d).select(
        "encounter_id", "patient_nbr", "race", "medical_specialty", "diag_1", *cleaning.CAPPED_COLUMNS,
        "age_midpoint", "change_flag", "diabetes_med_flag", "readmit_30d",
    )


def caps(spark, d):
    """Each step over the whole raw table: missing tokens, exclusion and caps without the dedup."""
    kept = cleaning.cap_outliers(cleaning.exclude_expired(cleaning.missing_to_null(view(spark, d, "admissions"))), 0.9)
    return kept.select("encounter_id", "max_glu_serum", *cleaning.CAPPED_COLUMNS)


def icd9_groups(spark, d):
    return sql_over(spark, d, ICD_TEXT).withColumn("disease_group", ef.icd9_group(F.col("code"))).drop("code")


def feature_steps(spark, d):
    df = view(spark, d, "admissions")
    df = ef.add_medication_churn(ef.add_lab_levels(ef.add_admin_groups(ef.add_diagnosis_groups(ef.add_utilization(df)))))
    return df.select(
        "encounter_id", F.col("num_prior_admissions").cast("bigint"), "diag_1_group", "diag_2_group", "diag_3_group",
        "admission_type_grp", "admission_source_grp", "discharge_disposition_grp", "a1c_result", "max_glu_serum_grp",
        "num_meds_changed", "num_meds_on",
    )


def collapsed(spark, d):
    df = cleaning.missing_to_null(view(spark, d, "admissions"))
    df = ef.collapse_rare(df, "medical_specialty")
    return df.groupBy(ef.known_or_unknown("medical_specialty").alias("specialty")).agg(F.count("*").alias("encounters"))


def missing_shares(spark, d):
    return ef.missing_shares(cleaning.missing_to_null(view(spark, d, "admissions")))


def class_weight(spark, d):
    from carepanel.operators.modeling import positive_class_weight

    return positive_class_weight(_features(spark, d), cleaning.TARGET)


def fold_sizes(spark, d):
    from carepanel.operators.modeling import with_folds

    folds = with_folds(_features(spark, d).persist(), cleaning.PATIENT, cleaning.TARGET, 5, 42)
    return folds.groupBy("fold", cleaning.TARGET).agg(F.count("*").alias("patients"))


def split_rows(spark, d):
    from carepanel.operators.modeling import with_split

    return with_split(_features(spark, d).persist(), cleaning.PATIENT, cleaning.TARGET, 42).select(cleaning.PATIENT, "is_test")


def metrics(spark, d):
    return _models(spark, d).drop("model_order")


def metrics_by_group(spark, d):
    return curves.evaluate(view(spark, d, "scores"), groups=("subgroup",))


def supplied_cuts(spark, d):
    return scoring.score_frame(view(spark, d, "scores"), (40.0, 75.0)).groupBy("tier").agg(F.count("*").alias("patients"))


def score_rows(spark, d):
    return _scores(spark, d).select("patient_id", "probability", "risk_score", "tier", "predicted_label")


def exact_shares(spark, d):
    counted = view(spark, d, "scores").groupBy("subgroup").agg(F.count("*").alias("patients"))
    return scoring.exact_percentages(counted, "subgroup")


def joined_labels(spark, d):
    return curves.scores_with_labels(
        _scores(spark, d).select("patient_id", "probability"), _features(spark, d), cleaning.PATIENT, cleaning.TARGET
    )


def contribution_rows(spark, d):
    rows = drivers.contribution_rows(_explained(spark, d), cleaning.PATIENT)
    return rows.withColumn("contribution", F.round("contribution", 6))


def global_drivers(spark, d):
    table = drivers.global_importance(_explained(spark, d), TERMS)
    return table.withColumn("relative_influence", F.round("relative_influence", 6))


def one_patient(spark, d):
    kept = cleaning.usable_first_encounters(view(spark, d, "admissions"))  # every one of them has features
    top = kept.agg(F.max(cleaning.PATIENT)).scalar()
    table = drivers.patient_drivers(_explained(spark, d), cleaning.PATIENT, top, 4)
    return table.withColumn("contribution", F.round("contribution", 6))


def bi_facts(spark, d):
    scores = _scores(spark, d).drop("y_true", "subgroup")
    return bi_export.patient_level(scores, _features(spark, d), cleaning.PATIENT, cleaning.TARGET)


def fairness_report_rows(spark, d):
    """D55: the nested audit report, one row per attribute: its subgroup records (counted, summed, the first one's
    size) and its gaps, as the JSON document carries them."""
    report = fairness.report(_subgroups(spark, d))
    return report.select(
        "attribute",
        F.size("subgroups").cast("long").alias("n_subgroups"),
        F.aggregate("subgroups", F.lit(0).cast("long"), lambda total, r: total + r["n"]).alias("patients"),
        F.col("subgroups")[0]["n"].cast("long").alias("largest_n"),
        "equal_opportunity_diff",
        "demographic_parity_diff",
        "worst_fnr_subgroup",
        "worst_fnr",
    )


def bi_fact_rows(spark, d):
    return bi_facts(spark, d).select(
        "patient_id", "risk_score", "tier", "predicted_label", F.col("actual_readmit_30d").cast("double"),
        "prediction_correct", "outcome_quadrant", "age_band", "diag_1_group", "num_prior_admissions",
    )


def observed_tiers(spark, d):
    return scoring.tier_summary(bi_facts(spark, d), actual="actual_readmit_30d")


def plan_summaries(spark, d):
    return care_plan.care_plans(_scores(spark, d)).select("patient_id", "summary")


def contact_rows(spark, d):
    return _log(spark, d).select("patient_id", F.col("last_contacted").cast("string"))


def upserted(spark, d):
    ids = view(spark, d, "scores").where(F.col("probability") >= 0.9).select("patient_id")
    merged = upsert_contacts(_log(spark, d), ids, AS_OF)
    return merged.withColumn("last_contacted", F.col("last_contacted").cast("string"))


def due_status(spark, d):
    return _status(spark, d).select(
        "patient_id", "tier", "status", "cadence_days", F.col("last_contacted").cast("string"), F.col("next_due").cast("string")
    )


def queue(spark, d):
    q = outreach.outreach_queue(_status(spark, d), 200)
    return q.withColumns({c: F.col(c).cast("string") for c in ("last_contacted", "next_due")})


def filtered_explorer(spark, d):
    return outreach.explorer(outreach.filter_panel(_scores(spark, d), ["High", "Medium"], 55, 90))


def patient_card(spark, d):
    scores = _scores(spark, d)
    first = outreach.pick_list(scores, 1).select("patient_id").scalar()
    return outreach.patient_card(scores, first).select(*scoring.EXPORT_COLUMNS)


def empty_view_pick_list(spark, d):
    scores = _scores(spark, d)
    return outreach.pick_list(outreach.filter_panel(scores, ["None"]), 100, fallback=scores)


def fairness_statement(spark, d):
    return fairness.worst_group_statement(fairness.fairness_gaps(_subgroups(spark, d)))


QUERIES = {
    "d02_numeric_coercion": numeric_coercion,
    "d04_d06_d08_caps_on_all_rows": caps,
    "d04_d11_cleaned_encounters": cleaned_rows,
    "d12_provenance": lambda s, d: cleaning.provenance(view(s, d, "admissions")),
    "d14_icd9_groups": icd9_groups,
    "d13_d18_feature_steps": feature_steps,
    "d19_d20_collapsed_specialty": collapsed,
    "d21_feature_table": _features,
    "d22_class_counts": lambda s, d: ef.class_counts(view(s, d, "admissions")),
    "d22_positive_rate": lambda s, d: ef.positive_rate(view(s, d, "admissions")),
    "d22_missing_shares": missing_shares,
    "d22_diagnosis_counts": lambda s, d: ef.diagnosis_counts(_features(s, d)),
    "d22_score_histogram": lambda s, d: ef.score_histogram(_scores(s, d)),
    "d23_split": split_rows,
    "d27_class_weight": class_weight,
    "d28_d31_metrics": metrics,
    "d28_d31_metrics_by_group": metrics_by_group,
    "d32_champion": lambda s, d: curves.champion(_models(s, d)),
    "d34_fold_sizes": fold_sizes,
    "d35_d38_d41_scores": score_rows,
    "d36_tier_cuts": lambda s, d: scoring.tier_cuts(_scores(s, d)),
    "d37_supplied_cuts": supplied_cuts,
    "d39_tier_summary": lambda s, d: scoring.tier_summary(_scores(s, d)),
    "d40_exact_percentages": exact_shares,
    "d42_score_export": lambda s, d: scoring.score_export(_scores(s, d)),
    "d43_d44_contributions": contribution_rows,
    "d45_top_factors": lambda s, d: drivers.top_factors(_explained(s, d), cleaning.PATIENT),
    "d46_global_drivers": global_drivers,
    "d47_one_patient_drivers": one_patient,
    "d48_threshold_sweep": _sweep,
    "d49_recommended_threshold": lambda s, d: curves.recommended_threshold(_sweep(s, d)),
    "d50_nearest_threshold": lambda s, d: curves.nearest_row(_sweep(s, d)),
    "d51_scores_with_labels": joined_labels,
    "d52_d53_d55_subgroups": _subgroups,
    "d53_subgroups_of_scores": _subgroups_of_scores,
    "d54_fairness_gaps": lambda s, d: fairness.fairness_gaps(_subgroups(s, d)),
    "d55_fairness_report": fairness_report_rows,
    "d56_d57_patient_level": bi_fact_rows,
    "d58_observed_tier_summary": observed_tiers,
    "d59_fairness_long": lambda s, d: bi_export.fairness_long([_subgroups(s, d), _subgroups_of_scores(s, d)]),
    "d60_model_metrics": lambda s, d: bi_export.flatten_metrics(_document(s, d)),
    "d62_care_plan_steps": lambda s, d: care_plan.plan_steps(care_plan.care_plans(_scores(s, d))),
    "d62_care_plan_summaries": plan_summaries,
    "e01_contact_log": contact_rows,
    "e02_upsert_contacts": upserted,
    "e03_due_status": due_status,
    "e04_queue_counts": lambda s, d: outreach.queue_counts(_status(s, d)),
    "e05_outreach_queue": queue,
    "e06_tier_counts": lambda s, d: outreach.tier_counts(_scores(s, d)),
    "e07_score_bands": lambda s, d: outreach.score_bands(_scores(s, d)),
    "e08_filtered_explorer": filtered_explorer,
    "e09_pick_list": lambda s, d: outreach.pick_list(_scores(s, d)),
    "e09_pick_list_of_empty_view": empty_view_pick_list,
    "e09_patient_card": patient_card,
    "e10_headline": lambda s, d: outreach.headline(_scores(s, d)),
    "e11_precision_recall_points": lambda s, d: curves.precision_recall_points(_sweep(s, d)),
    "e12_champion_confusion": lambda s, d: bi_export.champion_confusion(_document(s, d)),
    "e12_top_three_drivers": lambda s, d: global_drivers(s, d).orderBy(F.desc("relative_influence"), "feature").limit(3).select("label"),
    "e13_group_view": lambda s, d: fairness.group_view(_subgroups(s, d)),
    "e13_fairness_statement": fairness_statement,
}
