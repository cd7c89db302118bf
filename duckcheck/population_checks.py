"""DuckDB twins for the population queries."""

from carepanel.sources.fixture_views import duck_cte

DERIVED = """derived AS (SELECT *, CAST(has_diabetes + has_hypertension + has_heart_disease + has_copd + has_ckd + has_cancer_history + has_depression AS INT) AS num_conditions,
  CAST(transportation_barrier + food_insecurity + housing_instability + social_isolation AS INT) AS sdoh_risk_score,
  CASE WHEN has_heart_disease = 1 OR (has_diabetes = 1 AND age >= 40) THEN 1 ELSE 0 END AS statin_eligible FROM fx_population),
pop AS (SELECT *, CASE WHEN statin_eligible = 1 AND statin_flag = 1 THEN 1 ELSE 0 END AS statin_prescribed,
  CASE WHEN statin_eligible = 1 AND statin_flag = 0 THEN 1 ELSE 0 END AS statin_gap FROM derived)"""

SCORED = """comps AS (SELECT *,
  CAST(least(40, has_heart_disease * 12 + has_diabetes * 10 + has_copd * 10 + has_ckd * 8 + has_cancer_history * 6 + has_hypertension * 4
    + has_depression * 4 + CASE WHEN num_conditions >= 3 THEN 6 ELSE 0 END) AS DOUBLE) AS condition_score,
  CAST(least(30, inpatient_admits_12m * 10 + ed_visits_12m * 5 + CASE WHEN last_pcp_visit_days > 365 THEN 8 ELSE 0 END) AS DOUBLE) AS utilization_score,
  CAST(least(20, CASE WHEN has_diabetes = 1 THEN CASE WHEN hba1c > 9 THEN 8 WHEN hba1c > 8 THEN 4 ELSE 0 END ELSE 0 END
    + CASE WHEN has_hypertension = 1 THEN CASE WHEN systolic_bp > 150 THEN 6 WHEN systolic_bp > 140 THEN 3 ELSE 0 END ELSE 0 END + statin_gap * 4
    + CASE WHEN has_diabetes = 1 AND diabetes_med_pdc < CAST(0.8 AS DOUBLE) THEN 4 ELSE 0 END
    + CASE WHEN has_hypertension = 1 AND htn_med_pdc < CAST(0.8 AS DOUBLE) THEN 4 ELSE 0 END) AS DOUBLE) AS clinical_score,
  CAST(least(10, sdoh_risk_score * 2.5) AS DOUBLE) AS social_score FROM pop),
rawscore AS (SELECT *, condition_score + utilization_score + clinical_score + social_score AS risk_score_raw FROM comps),
sc AS (SELECT *, round_even(risk_score_raw / (SELECT max(risk_score_raw) FROM rawscore) * 100, 1) AS risk_score FROM rawscore),
panel AS (SELECT *, CASE WHEN risk_score <= 20 THEN 'LOW' WHEN risk_score <= 40 THEN 'MODERATE' WHEN risk_score <= 65 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_tier,
  CASE WHEN risk_score <= 25 THEN 'Tier1_Low' WHEN risk_score <= 50 THEN 'Tier2_Med' WHEN risk_score <= 75 THEN 'Tier3_High' ELSE 'Tier4_Critical' END AS predicted_cost_tier,
  CASE WHEN risk_score <= 20 THEN 'Standard Preventive Care' WHEN risk_score <= 40 THEN 'Disease Management Program' WHEN risk_score <= 65 THEN 'Care Management'
       ELSE 'Intensive Case Management' END AS care_management_level FROM sc)"""

_PDC = "concat(CAST(CAST(round({c} * 100) AS INT) AS STRING), '%')"
GAP_SQL = [
    ("has_diabetes = 1 AND days_since_hba1c > 365", "HbA1c_Overdue", "'HbA1c test overdue (>12 months)'", "'HIGH'",
     "Order HbA1c lab — can be standing order or during next visit", "days_since_hba1c - 365"),
    ("has_diabetes = 1 AND hba1c > 9 AND days_since_hba1c <= 365", "Uncontrolled_Diabetes",
     "concat('Poor glycemic control — HbA1c ', CAST(hba1c AS STRING), '%')", "'CRITICAL'",
     "Urgent care manager outreach — medication review and endocrinology referral", "0"),
    ("has_diabetes = 1 AND diabetes_med_pdc < CAST(0.8 AS DOUBLE)", "DM_Med_Adherence",
     "concat('Diabetes medication non-adherence — PDC ', " + _PDC.format(c="diabetes_med_pdc") + ")", "'HIGH'",
     "Pharmacy outreach — barrier assessment, pill pack consideration", "0"),
    ("has_hypertension = 1 AND (systolic_bp >= 160 OR diastolic_bp >= 100)", "Uncontrolled_HTN_Severe",
     "concat('Severe uncontrolled BP: ', CAST(systolic_bp AS STRING), '/', CAST(diastolic_bp AS STRING))", "'CRITICAL'",
     "Same-day nurse callback — check if patient symptomatic, urgent PCP appointment", "0"),
    ("has_hypertension = 1 AND systolic_bp < 160 AND diastolic_bp < 100 AND (systolic_bp >= 140 OR diastolic_bp >= 90)", "Uncontrolled_HTN",
     "concat('Uncontrolled BP: ', CAST(systolic_bp AS STRING), '/', CAST(diastolic_bp AS STRING))", "'HIGH'",
     "Schedule follow-up visit for medication adjustment", "0"),
    ("has_hypertension = 1 AND htn_med_pdc < CAST(0.8 AS DOUBLE)", "HTN_Med_Adherence",
     "concat('Hypertension medication non-adherence — PDC ', " + _PDC.format(c="htn_med_pdc") + ")", "'HIGH'",
     "Pharmacy outreach — cost barrier assessment, generic alternatives", "0"),
    ("statin_gap = 1", "Statin_Gap", "'Statin not prescribed — eligible patient (CAD or diabetes age 40+)'", "'HIGH'",
     "PCP notification — add statin to medication regimen at next visit", "0"),
    ("colonoscopy_due = 1", "Colorectal_Screening", "'Colorectal cancer screening overdue'", "'MODERATE'",
     "Schedule colonoscopy or offer FIT test alternative", "0"),
    ("mammogram_due = 1", "Mammogram_Screening", "'Mammogram overdue'", "'MODERATE'",
     "Schedule mammogram — can offer mobile mammography if transportation barrier", "0"),
    ("insurance IN ('Medicare', 'Medicare_Advantage') AND awv_completed = 0", "Annual_Wellness_Visit",
     "'Annual Wellness Visit not completed this year'", "'MODERATE'", "Outreach to schedule AWV — covered at no cost to patient", "0"),
    ("last_pcp_visit_days > 365", "Lost_to_Followup", "concat('No PCP visit in ', CAST(last_pcp_visit_days AS STRING), ' days')",
     "CASE WHEN num_conditions >= 2 THEN 'HIGH' ELSE 'MODERATE' END",
     "Reconnection outreach — identify barriers, offer telehealth", "last_pcp_visit_days - 365"),
    ("sdoh_risk_score >= 2", "SDOH_High_Risk", "concat('High SDOH risk score: ', CAST(sdoh_risk_score AS STRING), '/4')", "'MODERATE'",
     "Social work referral — address transportation, food, housing barriers", "0"),
]

GAPS = "g0 AS (" + " UNION ALL ".join(
    f"SELECT patient_token, age, risk_tier, risk_score, num_conditions, has_diabetes, has_hypertension, contact_preference, mychart_enrolled, "
    f"'{t}' AS gap_type, {desc} AS description, {pr} AS priority, '{act}' AS recommended_action, CAST({days} AS INT) AS gap_days, {i} AS ord FROM panel WHERE {cond}"
    for i, (cond, t, desc, pr, act, days) in enumerate(GAP_SQL)
) + "), gaps AS (SELECT *, CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MODERATE' THEN 2 ELSE 3 END AS priority_rank FROM g0)"

SUMMARY = """summ AS (SELECT patient_token, CAST(count(*) AS INT) AS num_gaps, min(priority_rank) AS highest_priority,
  string_agg(gap_type, ', ' ORDER BY gap_type) AS gap_types, arg_min(recommended_action, priority_rank * 100 + ord) AS top_action FROM gaps GROUP BY patient_token)"""

_M = [
    ("CDC_HbA1c_Testing", "Comprehensive Diabetes Care — HbA1c Testing", "has_diabetes = 1", "days_since_hba1c <= 365", "days_since_hba1c > 365", 88, 90, "false"),
    ("CDC_HbA1c_Control", "Comprehensive Diabetes Care — HbA1c Control (<8.0%)", "has_diabetes = 1 AND days_since_hba1c <= 365", "hba1c < 8", "hba1c >= 8", 58, 65, "false"),
    ("CDC_Poor_HbA1c_Control", "Comprehensive Diabetes Care — Poor HbA1c Control (>9.0%)", "has_diabetes = 1 AND days_since_hba1c <= 365", "hba1c > 9", "hba1c > 9", 21, 18, "true"),
    ("CBP_Blood_Pressure_Control", "Controlling High Blood Pressure (<140/90)", "has_hypertension = 1", "systolic_bp < 140 AND diastolic_bp < 90", "NOT (systolic_bp < 140 AND diastolic_bp < 90)", 62, 70, "false"),
    ("COL_Colorectal_Screening", "Colorectal Cancer Screening", "age BETWEEN 45 AND 75", "colonoscopy_due = 0", "colonoscopy_due = 1", 68, 75, "false"),
    ("BCS_Breast_Cancer_Screening", "Breast Cancer Screening (Mammogram)", "gender = 'F' AND age BETWEEN 50 AND 74", "mammogram_due = 0", "mammogram_due = 1", 72, 78, "false"),
    ("SPC_Statin_Cardiovascular", "Statin Use in Cardiovascular Disease", "statin_eligible = 1", "statin_prescribed = 1", "statin_prescribed = 0", 78, 85, "false"),
    ("MAD_Diabetes_Adherence", "Medication Adherence — Diabetes Medications (PDC≥80%)", "has_diabetes = 1", "diabetes_med_pdc >= CAST(0.8 AS DOUBLE)", "diabetes_med_pdc < CAST(0.8 AS DOUBLE)", 83, 87, "false"),
    ("MAH_Hypertension_Adherence", "Medication Adherence — Hypertension (PDC≥80%)", "has_hypertension = 1", "htn_med_pdc >= CAST(0.8 AS DOUBLE)", "htn_med_pdc < CAST(0.8 AS DOUBLE)", 81, 86, "false"),
    ("AWV_Annual_Wellness", "Annual Wellness Visit Completion (Medicare)", "insurance IN ('Medicare', 'Medicare_Advantage')", "awv_completed = 1", "awv_completed = 0", 52, 65, "false"),
]

MEASURES = "m AS (" + " UNION ALL ".join(
    f"SELECT '{i}' AS measure_id, '{n}' AS measure_name, count(*) AS denominator, count(*) FILTER (WHERE {num}) AS numerator, "
    f"count(*) FILTER (WHERE {gap}) AS gap_patient_count, CAST({avg} AS DOUBLE) AS national_average, CAST({tgt} AS DOUBLE) AS target, {low} AS lower_is_better, "
    f"coalesce(CAST(count(*) FILTER (WHERE {num}) AS DOUBLE) / nullif(count(*), 0) * 100, 0) AS raw_rate FROM pop WHERE {den}"
    for i, n, den, num, gap, avg, tgt, low in _M
) + ")"
_MEETS = "CASE WHEN lower_is_better THEN raw_rate <= target ELSE raw_rate >= target END"

BASE = f"WITH {duck_cte('population')}, {DERIVED}"
W = f"{BASE}, {SCORED}, {GAPS}, {SUMMARY}, {MEASURES} "

WORKLIST = """SELECT CAST(row_number() OVER (ORDER BY highest_priority, risk_score DESC, num_gaps DESC, patient_token) AS INT) AS outreach_priority,
  patient_token, age, risk_tier, risk_score, label AS highest_priority_label, num_gaps, gap_types, top_action,
  CASE WHEN label = 'CRITICAL' THEN 'PHONE — Same day' WHEN mychart_enrolled = 1 THEN 'MyChart message' WHEN contact_preference = 'Text' THEN 'Text message'
       ELSE 'Phone call' END AS suggested_channel, num_conditions, has_diabetes, has_hypertension, last_pcp_visit_days
  FROM (SELECT panel.*, summ.* EXCLUDE (patient_token), CASE highest_priority WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MODERATE' ELSE 'LOW' END AS label
        FROM panel JOIN summ USING (patient_token)) ORDER BY outreach_priority LIMIT """


def _pct(num, den="count(*)", d=1):
    return f"round_even(CAST({num} AS DOUBLE) / {den} * 100, {d})"


def _shares(named, key, src, where="TRUE"):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {key}, CAST(coalesce(sum({c}), 0) AS BIGINT) AS patients, round_even(avg({c}) * 100, 1) AS pct FROM {src} WHERE {where}" for n, c in named
    )


def _domain(values, key, src, where="TRUE", n="patients", pct=True):
    out = []
    for i, v in enumerate(values):
        p = f", round_even(CAST(count(*) FILTER (WHERE {key} = '{v}') AS DOUBLE) / count(*) * 100, 1) AS pct" if pct else ""
        out.append(f"SELECT {i} AS position, '{v}' AS {key}, count(*) FILTER (WHERE {key} = '{v}') AS {n}{p} FROM {src} WHERE {where}")
    return " UNION ALL ".join(out)


def _hist(edges, labels, col, where="TRUE"):
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{lab}' AS band, count(*) FILTER (WHERE {col} > {lo} AND {col} <= {hi}) AS patients FROM fx_population WHERE {where}"
        for i, (lo, hi, lab) in enumerate(zip(edges, edges[1:], labels))
    )


_SIX = [("Hypertension", "has_hypertension"), ("Diabetes", "has_diabetes"), ("Heart Disease", "has_heart_disease"), ("COPD", "has_copd"),
        ("CKD", "has_ckd"), ("Depression", "has_depression")]
_GLY = [("Well Controlled (<7)", 0, 7), ("Controlled (7-8)", 7, 8), ("Suboptimal (8-9)", 8, 9), ("Poor Control (>9)", 9, 20)]

CHECKS = {
    "c01_derived_columns": BASE + " SELECT patient_token, num_conditions, sdoh_risk_score, statin_eligible, statin_prescribed, statin_gap FROM pop",
    "c02_c05_component_scores": W + "SELECT patient_token, condition_score, utilization_score, clinical_score, social_score FROM comps",
    "c06_c09_risk_tiers": W + "SELECT patient_token, risk_score_raw, risk_score, risk_tier, predicted_cost_tier, care_management_level FROM panel",
    "c10_c19_c21_measure_table": W + f"""SELECT measure_id, measure_name, denominator, numerator, round_even(raw_rate, 1) AS rate, national_average, target, lower_is_better,
        round_even(target - raw_rate, 1) AS gap_to_target, {_MEETS} AS meets_target, gap_patient_count FROM m""",
    "c20_gap_patients": BASE + " " + " UNION ALL ".join(f"SELECT '{i}' AS measure_id, patient_token FROM pop WHERE ({den}) AND ({gap})" for i, _, den, _, gap, *_ in _M),
    "c22_measure_status": W + f"""SELECT measure_id, round_even(raw_rate, 1) AS rate, national_average, target, CASE WHEN {_MEETS} THEN 'PASS'
        WHEN CASE WHEN lower_is_better THEN raw_rate <= national_average ELSE raw_rate >= national_average END THEN 'NEAR' ELSE 'FAIL' END AS status FROM m""",
    "c23_c35_care_gaps": W + "SELECT * EXCLUDE (ord) FROM gaps",
    "c36_gap_summary": W + "SELECT * FROM summ",
    "c36_c38_daily_worklist": W + WORKLIST + "30",
    "c37_worklist_from_gap_table": W + WORKLIST + "100",
    "c39_tier_distribution": W + _domain(["VERY_HIGH", "HIGH", "MODERATE", "LOW"], "risk_tier", "panel"),
    "c40_disease_prevalence": BASE + " " + _shares(_SIX, "condition", "fx_population"),
    "c41_gap_totals": W + """SELECT count(*) AS total_gaps, count(DISTINCT patient_token) AS patients_with_gaps,
        round_even(CAST(count(DISTINCT patient_token) AS DOUBLE) / (SELECT count(*) FROM panel) * 100, 1) AS pct_of_population,
        round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT patient_token), 1) AS gaps_per_patient FROM gaps""",
    "c41_gap_priority_shares": W + "SELECT * EXCLUDE (position) FROM (" + _domain(["CRITICAL", "HIGH", "MODERATE"], "priority", "gaps", n="gaps") + ")",
    "c42_top_gap_types": W + """SELECT gap_type, count(*) AS patients, round_even(CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT patient_token) FROM gaps) * 100, 1)
        AS pct_of_patients_with_gaps FROM gaps GROUP BY gap_type ORDER BY patients DESC, gap_type LIMIT 5""",
    "c43_social_prevalence": BASE + " " + _shares([("Transportation barriers", "transportation_barrier"), ("Food insecurity", "food_insecurity"),
        ("Housing instability", "housing_instability"), ("Social isolation", "social_isolation"),
        ("High SDOH risk (2+ factors)", "CASE WHEN sdoh_risk_score >= 2 THEN 1 ELSE 0 END")], "social_risk", "pop"),
    "c44_financial_impact": W + """SELECT (SELECT round_even(sum(CASE WHEN NOT lower_is_better THEN greatest(0, target - raw_rate) END) / count(*), 1) FROM m) AS mean_gap_to_target_pp,
        (SELECT count(*) FROM pop WHERE insurance IN ('Medicare', 'Medicare_Advantage')) AS medicare_members,
        (SELECT count(*) FROM pop WHERE insurance IN ('Medicare', 'Medicare_Advantage')) * 450 AS star_improvement_value,
        cr AS critical_gaps, hi AS high_gaps, round_even(cr * CAST(0.3 AS DOUBLE) + hi * CAST(0.15 AS DOUBLE), 2) AS avoided_admissions,
        round_even((cr * CAST(0.3 AS DOUBLE) + hi * CAST(0.15 AS DOUBLE)) * 18000, 0) AS avoided_cost
        FROM (SELECT count(*) FILTER (WHERE priority = 'CRITICAL') AS cr, count(*) FILTER (WHERE priority = 'HIGH') AS hi FROM gaps)""",
    "c45_engagement": BASE + f""" SELECT round_even(avg(mychart_enrolled) * 100, 1) AS portal_enrollment_pct, count(*) FILTER (WHERE last_pcp_visit_days > 365) AS lost_to_followup,
        {_pct("count(*) FILTER (WHERE last_pcp_visit_days > 365)")} AS lost_to_followup_pct FROM fx_population""",
    "c45_contact_preferences": BASE + f" SELECT contact_preference, count(*) AS patients, {_pct('count(*)', '(SELECT count(*) FROM fx_population)')} AS pct FROM fx_population GROUP BY 1",
    "c46_glycemic_bands": BASE + " " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{b}' AS glycemic_control, count(*) FILTER (WHERE hba1c > {lo} AND hba1c <= {hi}) AS patients, "
        f"{_pct(f'count(*) FILTER (WHERE hba1c > {lo} AND hba1c <= {hi})')} AS pct FROM fx_population WHERE has_diabetes = 1" for i, (b, lo, hi) in enumerate(_GLY)),
    "c47_hba1c_statistics": BASE + f""" SELECT count(*) AS diabetic_patients, round_even(avg(hba1c), 1) AS mean_hba1c, round_even(median(hba1c), 1) AS median_hba1c,
        count(*) FILTER (WHERE hba1c > 8) AS above_8, count(*) FILTER (WHERE hba1c > 9) AS above_9, {_pct("count(*) FILTER (WHERE hba1c > 8)")} AS above_8_pct,
        {_pct("count(*) FILTER (WHERE hba1c > 9)")} AS above_9_pct FROM fx_population WHERE has_diabetes = 1""",
    "c48_diabetic_comorbidity": BASE + " " + _shares([("Also have Hypertension", "has_hypertension"), ("Also have Heart Disease", "has_heart_disease"),
        ("Also have CKD", "has_ckd"), ("Also have Depression", "has_depression")], "comorbidity", "fx_population", "has_diabetes = 1"),
    "c49_diabetic_adherence": BASE + f""" SELECT round_even(avg(diabetes_med_pdc), 2) AS mean_pdc, count(*) FILTER (WHERE diabetes_med_pdc < CAST(0.8 AS DOUBLE)) AS non_adherent,
        {_pct("count(*) FILTER (WHERE diabetes_med_pdc < CAST(0.8 AS DOUBLE))")} AS non_adherent_pct FROM fx_population WHERE has_diabetes = 1""",
    "c50_critical_diabetics": W + """SELECT count(*) AS patients, round_even(avg(hba1c), 1) AS mean_hba1c, round_even(avg(risk_score), 1) AS mean_risk_score
        FROM panel WHERE has_diabetes = 1 AND hba1c > 9 AND days_since_hba1c <= 365""",
    "c51_intervention_targets": BASE + """ SELECT count(*) FILTER (WHERE hba1c > 9) AS priority_1_above_9, count(*) FILTER (WHERE hba1c > 8 AND hba1c <= 9) AS priority_2_8_to_9,
        count(*) FILTER (WHERE diabetes_med_pdc < CAST(0.8 AS DOUBLE)) AS priority_3_non_adherent, count(*) FILTER (WHERE days_since_hba1c > 365) AS priority_4_overdue
        FROM fx_population WHERE has_diabetes = 1""",
    "c52_closure_projection": W + """SELECT measure_id, lower_is_better, CAST(closed AS BIGINT) AS patients_closed, round_even(raw_rate, 1) AS current_rate,
        round_even(nr, 1) AS projected_rate, round_even(nr - raw_rate, 1) AS gain_pp FROM (SELECT *, least((numerator + closed) / denominator * 100, 99) AS nr
        FROM (SELECT *, CAST(floor(gap_patient_count * CAST(0.45 AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS DOUBLE) AS closed FROM m WHERE denominator > 0 AND gap_patient_count > 0))""",
    "c53_program_return": BASE + """ SELECT s AS star_bonus, d AS diabetes_savings, s + d AS total_impact, s + d - 250000 AS net_return, round_even((s + d) / 250000, 1) AS return_ratio
        FROM (SELECT CAST(count(*) FILTER (WHERE insurance IN ('Medicare', 'Medicare_Advantage')) * 450 AS DOUBLE) / 2 AS s,
                     round_even(sum(has_diabetes) * CAST(0.15 AS DOUBLE) * 12000 * CAST(0.3 AS DOUBLE), 2) AS d FROM fx_population)""",
    "c55_json_snapshot": W + """SELECT '2024-04-01' AS generated_at, count(*) AS population_size, count(*) FILTER (WHERE risk_tier = 'LOW') AS low,
        count(*) FILTER (WHERE risk_tier = 'MODERATE') AS moderate, (SELECT count(*) FROM gaps) AS total_care_gaps,
        (SELECT count(DISTINCT patient_token) FROM gaps) AS patients_with_gaps, 10 AS measure_records, (SELECT sum(round_even(raw_rate, 1)) FROM m) AS rate_sum FROM panel""",
    "c56_headline": W + f"""SELECT count(*) AS attributed_patients, count(*) FILTER (WHERE risk_tier = 'VERY_HIGH') AS very_high,
        {_pct("count(*) FILTER (WHERE risk_tier = 'VERY_HIGH')")} AS very_high_pct, (SELECT count(*) FROM gaps) AS open_gaps,
        (SELECT count(DISTINCT patient_token) FROM gaps) AS patients_with_gaps, {_pct("(SELECT count(DISTINCT patient_token) FROM gaps)")} AS patients_with_gaps_pct,
        (SELECT count(*) FROM m WHERE {_MEETS}) AS measures_met, (SELECT count(*) FROM m) AS measures FROM panel""",
    "c57_age_histogram": BASE + " " + _hist([18, 30, 45, 55, 65, 75, 95], ["18-29", "30-44", "45-54", "55-64", "65-74", "75+"], "age"),
    "c58_hba1c_histogram": BASE + " " + _hist([4, 6, 7, 8, 9, 10, 11, 15], ["(4, 6]", "(6, 7]", "(7, 8]", "(8, 9]", "(9, 10]", "(10, 11]", "(11, 15]"], "hba1c", "has_diabetes = 1"),
    "c59_care_levels": W + "SELECT care_management_level, count(*) AS patients FROM panel GROUP BY 1",
    "c60_tier_filter": W + "SELECT patient_token, risk_tier, risk_score FROM panel WHERE risk_tier IN ('HIGH', 'VERY_HIGH')",
    "c60_gap_explorer": W + """SELECT patient_token, age, risk_tier, risk_score, gap_type, priority, description, recommended_action FROM gaps
        WHERE priority IN ('CRITICAL', 'HIGH') ORDER BY priority_rank, risk_score DESC, patient_token, ord LIMIT 500""",
    "c61_gap_priority_series": W + "SELECT * FROM (" + _domain(["CRITICAL", "HIGH", "MODERATE", "LOW"], "priority", "gaps", n="gaps", pct=False) + ") WHERE gaps > 0",
    "c61_frequent_gap_types": W + "SELECT gap_type, count(*) AS gaps FROM gaps GROUP BY 1 ORDER BY gaps DESC, gap_type LIMIT 8",
    "c62_tier_series": W + _domain(["LOW", "MODERATE", "HIGH", "VERY_HIGH"], "risk_tier", "panel", pct=False),
    "c62_prevalence_series": BASE + " SELECT condition, pct FROM (" + _shares(_SIX, "condition", "fx_population") + ")",
    "c62_social_series": BASE + " SELECT social_risk, patients FROM (" + _shares([("Transportation", "transportation_barrier"), ("Food insecurity", "food_insecurity"),
        ("Housing", "housing_instability"), ("Social isolation", "social_isolation")], "social_risk", "fx_population") + ")",
    "c63_status_view": W + f"""SELECT measure_name AS measure, denominator AS denom, numerator AS numer, round_even(raw_rate, 1) AS rate_pct, national_average AS natl_avg_pct,
        target AS target_pct, round_even(target - raw_rate, 1) AS gap_to_target, CASE WHEN {_MEETS} THEN 'Meets target' ELSE 'Below target' END AS status FROM m""",
    "c63_rate_vs_target": W + "SELECT measure_id, round_even(raw_rate, 1) AS rate, target, national_average FROM m",
}
