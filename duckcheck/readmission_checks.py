"""DuckDB twins for the readmission and outreach queries."""

from carepanel.sources.fixture_views import duck_cte

ADM = duck_cte("admissions")
SCO = duck_cte("scores")
LOG = duck_cte("contact_log")

_CAPS = ["time_in_hospital", "num_medications", "number_outpatient", "number_emergency", "number_inpatient"]
_TEXT = ["race", "gender", "age", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3", "A1Cresult", "max_glu_serum",
         "insulin", "metformin", "glipizide", "change", "diabetesMed", "readmitted"]
NULLED = "nulled AS (SELECT * REPLACE (" + ", ".join(f"nullif({c}, '?') AS {c}" for c in _TEXT) + ") FROM fx_admissions)"
KEPT = "kept AS (SELECT * FROM nulled WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21))"
FIRST = "firsts AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1)"


def _cap(src, q):
    return ", ".join(f"least(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), {q}) FROM {src})) AS {c}" for c in _CAPS)


CLEAN = f"""cleaned AS (SELECT * REPLACE ({_cap('firsts', 0.99)}),
  (CAST(regexp_extract(age, '(\\d+)-(\\d+)', 1) AS DOUBLE) + CAST(regexp_extract(age, '(\\d+)-(\\d+)', 2) AS DOUBLE)) / 2 AS age_midpoint,
  CASE WHEN change = 'Ch' THEN 1 ELSE 0 END AS change_flag, CASE WHEN diabetesMed = 'Yes' THEN 1 ELSE 0 END AS diabetes_med_flag,
  CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmit_30d FROM firsts)"""


def icd(c):
    n = f"TRY_CAST(trim({c}) AS DOUBLE)"
    w = f"floor({n})"
    return f"""CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'nan') THEN 'Missing' WHEN trim({c}) LIKE 'V%' THEN 'Other' WHEN trim({c}) LIKE 'E%' THEN 'Injury'
      WHEN {n} IS NULL THEN 'Other' WHEN {n} >= 250 AND {n} < 251 THEN 'Diabetes' WHEN {w} BETWEEN 390 AND 459 OR {w} = 785 THEN 'Circulatory'
      WHEN {w} BETWEEN 460 AND 519 OR {w} = 786 THEN 'Respiratory' WHEN {w} BETWEEN 520 AND 579 OR {w} = 787 THEN 'Digestive'
      WHEN {w} BETWEEN 800 AND 999 THEN 'Injury' WHEN {w} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
      WHEN {w} BETWEEN 580 AND 629 OR {w} = 788 THEN 'Genitourinary' WHEN {w} BETWEEN 140 AND 239 THEN 'Neoplasm' ELSE 'Other' END"""


_ADMIN = """CASE WHEN admission_type_id IS NULL THEN 'Unknown' WHEN admission_type_id = 1 THEN 'Emergency' WHEN admission_type_id = 2 THEN 'Urgent' WHEN admission_type_id = 3 THEN 'Elective'
    WHEN admission_type_id = 4 THEN 'Newborn' WHEN admission_type_id = 7 THEN 'Trauma' WHEN admission_type_id IN (5, 6, 8) THEN 'Unknown' ELSE 'Other' END AS admission_type_grp,
  CASE WHEN admission_source_id IS NULL THEN 'Unknown' WHEN admission_source_id = 1 THEN 'Physician Referral' WHEN admission_source_id = 2 THEN 'Clinic Referral'
    WHEN admission_source_id = 3 THEN 'HMO Referral' WHEN admission_source_id IN (4, 5, 6, 10, 18, 22, 25) THEN 'Transfer' WHEN admission_source_id = 7 THEN 'Emergency Room'
    WHEN admission_source_id IN (11, 12, 13, 14) THEN 'Birth' ELSE 'Other' END AS admission_source_grp,
  CASE WHEN discharge_disposition_id IS NULL THEN 'Unknown' WHEN discharge_disposition_id = 1 THEN 'Home' WHEN discharge_disposition_id IN (6, 8) THEN 'Home Health'
    WHEN discharge_disposition_id IN (2, 3, 4, 5, 22, 23, 24) THEN 'Transferred Facility' WHEN discharge_disposition_id = 7 THEN 'AMA' ELSE 'Other' END AS discharge_disposition_grp"""
_MEDS = """CAST((insulin IN ('Up', 'Down'))::INT + (metformin IN ('Up', 'Down'))::INT + (glipizide IN ('Up', 'Down'))::INT AS INT) AS num_meds_changed,
  CAST((insulin <> 'No')::INT + (metformin <> 'No')::INT + (glipizide <> 'No')::INT AS INT) AS num_meds_on"""

_D = "CAST({0} AS DOUBLE) AS {0}"
FEATURES = f"""lv AS (SELECT medical_specialty AS lvl, count(*) AS n FROM cleaned GROUP BY 1),
feats AS (SELECT patient_nbr, encounter_id, readmit_30d, age_midpoint, time_in_hospital, {_D.format('num_lab_procedures')}, {_D.format('num_procedures')}, num_medications,
  number_outpatient, number_emergency, number_inpatient, CAST(number_diagnoses AS DOUBLE) AS num_chronic_conditions,
  number_inpatient + number_emergency + number_outpatient AS num_prior_admissions,
  CAST((insulin IN ('Up', 'Down'))::INT + (metformin IN ('Up', 'Down'))::INT + (glipizide IN ('Up', 'Down'))::INT AS DOUBLE) AS num_meds_changed,
  CAST((insulin <> 'No')::INT + (metformin <> 'No')::INT + (glipizide <> 'No')::INT AS DOUBLE) AS num_meds_on, CAST(change_flag AS DOUBLE) AS change_flag,
  CAST(diabetes_med_flag AS DOUBLE) AS diabetes_med_flag, coalesce(race, 'Unknown') AS race, coalesce(gender, 'Unknown') AS gender,
  CASE WHEN (SELECT any_value(n) FROM lv WHERE lvl IS NOT DISTINCT FROM medical_specialty) >= 0.01 * (SELECT count(*) FROM cleaned)
       THEN coalesce(medical_specialty, 'Unknown') ELSE 'Other' END AS medical_specialty_grp,
  {_ADMIN}, {icd('diag_1')} AS diag_1_group, {icd('diag_2')} AS diag_2_group, {icd('diag_3')} AS diag_3_group,
  coalesce(A1Cresult, 'None') AS a1c_result, coalesce(max_glu_serum, 'None') AS max_glu_serum_grp, coalesce(insulin, 'Unknown') AS insulin FROM cleaned)"""

SCORED = """s0 AS (SELECT *, CAST(round_even(probability * 100, 0) AS INT) AS risk_score FROM fx_scores),
sc AS (SELECT *, CASE WHEN risk_score >= (SELECT quantile_cont(CAST(risk_score AS DOUBLE), 0.8) FROM s0) THEN 'High'
  WHEN risk_score >= (SELECT quantile_cont(CAST(risk_score AS DOUBLE), 0.5) FROM s0) THEN 'Medium' ELSE 'Low' END AS tier,
  CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS predicted_label FROM s0)"""

CLEANED = f"WITH {ADM}, {NULLED}, {KEPT}, {FIRST}, {CLEAN} "
F_ = f"WITH {ADM}, {NULLED}, {KEPT}, {FIRST}, {CLEAN}, {FEATURES} "
S_ = f"WITH {SCO}, {SCORED} "
FS_ = f"WITH {ADM}, {NULLED}, {KEPT}, {FIRST}, {CLEAN}, {FEATURES}, {SCO}, {SCORED} "

_DIGEST = "(('0x' || substr(md5(concat(CAST(patient_nbr AS STRING), ':42')), 1, 8))::BIGINT)"
FOLDED = f"""folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY readmit_30d ORDER BY {_DIGEST} % 4096, {_DIGEST}, patient_nbr) - 1) % 5 AS INT) AS fold FROM feats)"""


def metrics_sql(src, label="y_true", pred="p >= 0.5", extra="", group=""):
    """Pairwise AUROC and average precision written the long way, over all row pairs by rank."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""(SELECT {g}{extra} round_even((sum(CASE WHEN y = 1 THEN avg_rank END) - npos * (npos + 1) / 2) / (npos * nneg), 4) AS auroc,
      round_even(sum(CASE WHEN y = 1 THEN CAST(tp_upto AS DOUBLE) / all_upto END) / npos, 4) AS pr_auc,
      round_even(avg((p - y) * (p - y)), 4) AS brier,
      count(*) FILTER (WHERE {pred} AND y = 1) AS tp, count(*) FILTER (WHERE {pred} AND y = 0) AS fp,
      count(*) FILTER (WHERE NOT ({pred}) AND y = 1) AS fn, count(*) FILTER (WHERE NOT ({pred}) AND y = 0) AS tn
      FROM (SELECT *, CAST(count(*) OVER ({part} ORDER BY p) AS DOUBLE) - (count(*) OVER (PARTITION BY {g}p) - 1) / CAST(2 AS DOUBLE) AS avg_rank,
        sum(y) OVER ({part} ORDER BY p DESC) AS tp_upto, count(*) OVER ({part} ORDER BY p DESC) AS all_upto,
        CAST(sum(y) OVER ({part}) AS DOUBLE) AS npos, CAST(sum(1 - y) OVER ({part}) AS DOUBLE) AS nneg FROM {src}) {gb + ", npos, nneg" if group else "GROUP BY npos, nneg"})"""


def full_metrics(inner, cols=""):
    return f"""SELECT {cols} auroc, pr_auc, brier, tp, fp, fn, tn, coalesce(round_even(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 4), 0) AS precision,
      coalesce(round_even(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 4), 0) AS recall, coalesce(round_even(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1,
      CAST(0.5 AS DOUBLE) AS threshold FROM {inner}"""


_BASE_SRC = "(SELECT probability AS p, y_true AS y, subgroup FROM fx_scores)"
_FLAT_SRC = "(SELECT probability * probability / 2 + CAST(0.25 AS DOUBLE) AS p, y_true AS y, subgroup FROM fx_scores)"
MODELS = f"""models AS ({full_metrics(metrics_sql(_BASE_SRC), "'logreg' AS model,")} UNION ALL {full_metrics(metrics_sql(_FLAT_SRC), "'gbm' AS model,")})"""
CHAMP = "champ AS (SELECT model FROM models ORDER BY pr_auc DESC, model DESC LIMIT 1)"

SWEEP = """steps AS (SELECT k, k * CAST(0.01 AS DOUBLE) AS t FROM (SELECT unnest(range(101)) AS k)),
sw0 AS (SELECT t, count(*) FILTER (WHERE probability >= t AND y_true = 1) AS tp, count(*) FILTER (WHERE probability >= t AND y_true = 0) AS fp,
  count(*) FILTER (WHERE probability < t AND y_true = 1) AS fn, count(*) FILTER (WHERE probability < t AND y_true = 0) AS tn FROM steps, fx_scores GROUP BY t),
sw AS (SELECT round_even(t, 3) AS threshold, tp, fp, fn, tn, round_even(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 4) AS precision,
  coalesce(round_even(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 4), 0) AS recall, coalesce(round_even(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1,
  tp + fp AS flagged, round_even(CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) * 100, 2) AS flagged_pct FROM sw0)"""
W_ = f"WITH {SCO}, {SWEEP} "

AUDIT = """aud AS (SELECT f.*, s.probability, s.predicted_label AS y_pred, f.readmit_30d AS y_true,
  CASE WHEN age_midpoint IS NULL THEN 'Unknown' WHEN age_midpoint < 50 THEN '<50' WHEN age_midpoint < 70 THEN '50-69' ELSE '70+' END AS age_band
  FROM feats f JOIN sc s ON f.patient_nbr = s.patient_id),
long0 AS (SELECT 'race' AS attribute, race AS subgroup, probability AS p, y_true AS y, y_pred FROM aud UNION ALL
  SELECT 'gender', gender, probability, y_true, y_pred FROM aud UNION ALL SELECT 'age_band', age_band, probability, y_true, y_pred FROM aud)"""
SEG = "seg AS (SELECT 'segment' AS attribute, subgroup, probability AS p, y_true AS y, predicted_label AS y_pred FROM sc)"


def _subs(src):
    return f"""(SELECT attribute, subgroup, n, n >= 100 AS reliable, round_even(CAST(pos AS DOUBLE) / n, 4) AS positive_rate,
      round_even((rs - pos * (pos + 1) / CAST(2 AS DOUBLE)) / nullif(CAST(pos AS DOUBLE) * (n - pos), 0), 4) AS auroc,
      round_even(CAST(tp AS DOUBLE) / nullif(pos, 0), 4) AS recall_tpr, round_even(1 - CAST(tp AS DOUBLE) / nullif(pos, 0), 4) AS fnr,
      round_even(CAST(fl AS DOUBLE) / n, 4) AS selection_rate FROM (
      SELECT attribute, subgroup, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos, sum(CASE WHEN y = 1 THEN rk END) AS rs, count(*) FILTER (WHERE y = 1 AND y_pred = 1) AS tp,
        count(*) FILTER (WHERE y_pred = 1) AS fl FROM (SELECT *, CAST(count(*) OVER (PARTITION BY attribute, subgroup ORDER BY p) AS DOUBLE)
          - (count(*) OVER (PARTITION BY attribute, subgroup, p) - 1) / CAST(2 AS DOUBLE) AS rk FROM {src} WHERE subgroup NOT IN ('Unknown', 'Unknown/Invalid', '?', 'None', 'nan', ''))
      GROUP BY 1, 2))"""


_REL = "FILTER (WHERE reliable)"
GAPS = f"""gapt AS (SELECT attribute,
  round_even(CASE WHEN count(recall_tpr) {_REL} > 1 THEN max(recall_tpr) {_REL} - min(recall_tpr) {_REL} ELSE 0 END, 4) AS equal_opportunity_diff,
  round_even(CASE WHEN count(selection_rate) {_REL} > 1 THEN max(selection_rate) {_REL} - min(selection_rate) {_REL} ELSE 0 END, 4) AS demographic_parity_diff,
  (SELECT subgroup FROM subs i WHERE i.attribute = o.attribute AND reliable AND fnr IS NOT NULL ORDER BY fnr DESC, n DESC, subgroup DESC LIMIT 1) AS worst_fnr_subgroup,
  round_even(max(fnr) {_REL}, 4) AS worst_fnr FROM subs o GROUP BY attribute)"""
A_ = f"{FS_.rstrip()}, {AUDIT}, {SEG}, subs AS {_subs('long0')}, {GAPS} "


def largest_remainder(src, order, n="patients"):
    """src must offer `patients` and the order column; returns pct_of_panel per row."""
    return f"""(SELECT * EXCLUDE (tot, raw, fl, rk, lft), (fl + CASE WHEN tot > 0 AND rk <= lft THEN 1 ELSE 0 END) / CAST(10 AS DOUBLE) AS pct_of_panel FROM (
      SELECT *, row_number() OVER (ORDER BY raw - fl DESC, {order}) AS rk, 1000 - sum(fl) OVER () AS lft FROM (SELECT *, floor(raw) AS fl FROM (
        SELECT *, CASE WHEN tot > 0 THEN CAST({n} AS DOUBLE) / tot * 100 * 10 ELSE 0 END AS raw FROM (SELECT *, sum({n}) OVER () AS tot FROM {src})))))"""


def _tsum(src, extra=""):
    return largest_remainder(
        f"""(SELECT tier, count(*) AS patients, round_even(avg(risk_score), 1) AS mean_score, round_even(avg(probability), 4) AS mean_probability{extra},
        CASE tier WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END AS position FROM {src} GROUP BY tier)""", "position")


_TERMS = [("number_inpatient", "0.31 * (number_inpatient - 2)"), ("num_prior_admissions", "0.12 * (num_prior_admissions - 4.5)"),
          ("time_in_hospital", "0.05 * (time_in_hospital - 7.5)"), ("age_midpoint", "0.01 * (coalesce(age_midpoint, 50) - 50)"),
          ("num_medications", "-0.02 * (num_medications - 30)"),
          ("diag_1_group", "CASE diag_1_group WHEN 'Diabetes' THEN 0.4 WHEN 'Circulatory' THEN 0.25 WHEN 'Injury' THEN -0.2 ELSE 0 END - 0.03125"),
          ("insulin", "CASE insulin WHEN 'Up' THEN 0.15 WHEN 'Down' THEN 0.07 ELSE 0 END - 0.055")]
_LABEL = {"number_inpatient": "prior inpatient visits", "num_prior_admissions": "prior admissions", "time_in_hospital": "days in hospital", "age_midpoint": "age",
          "num_medications": "medications", "diag_1_group": "primary diagnosis", "insulin": "insulin"}
_NUM = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS STRING) ELSE CAST(round_even({0}, 1) AS STRING) END"


def _val(f):
    return f if f in ("diag_1_group", "insulin") else _NUM.format(f)


CONTRIB = "contrib AS (" + " UNION ALL ".join(
    f"SELECT patient_nbr, '{f}' AS feature, {i} AS ord, CAST({e} AS DOUBLE) AS v, '{_LABEL[f]}' AS label, {_val(f)} AS pv FROM feats" for i, (f, e) in enumerate(_TERMS)
) + ")"
C_ = f"{F_.rstrip()}, {CONTRIB} "

_IMPORTANCE = """SELECT feature, any_value(label) AS label, round(avg(abs(v)) / (SELECT sum(m) FROM (SELECT avg(abs(v)) AS m FROM contrib GROUP BY feature)) * 100, 6)
  AS relative_influence FROM contrib GROUP BY feature"""

RULES = [
    ("prior inpatient", "Transitional care", "Enroll in Transitional Care Management; nurse call within 48h of discharge", "High"),
    ("prior admissions", "Transitional care", "Assign a care coordinator for 30-day post-discharge monitoring", "High"),
    ("prior er", "Utilization", "Review ED utilization drivers; set up an ambulatory care access plan", "High"),
    ("insulin", "Diabetes management", "Diabetes educator review of insulin regimen; confirm glucometer + supplies", "High"),
    ("diabetes", "Diabetes management", "Reinforce diabetes self-management education and dietary counseling", "Medium"),
    ("hba1c", "Diabetes management", "Endocrinology follow-up for glycemic control; recheck HbA1c in 4-6 weeks", "Medium"),
    ("glucose", "Diabetes management", "Establish home glucose monitoring with logging and clinician review", "Medium"),
    ("diagnoses on record", "Complex care", "Complete medication reconciliation across all conditions", "High"),
    ("medications changed", "Medication safety", "Pharmacist review of medication changes; counsel on adherence", "High"),
    ("active medications", "Medication safety", "Assess polypharmacy risk; simplify regimen where possible", "Medium"),
    ("medications", "Medication safety", "Pharmacist-led medication reconciliation and adherence check", "Medium"),
    ("days in hospital", "Home support", "Order home health assessment given the prolonged length of stay", "Medium"),
    ("discharge disposition", "Care transitions", "Confirm discharge destination has adequate support and follow-up", "Medium"),
    ("primary diagnosis", "Disease-specific", "Coordinate specialist follow-up for the primary diagnosis", "Medium"),
    ("age", "Geriatric care", "Fall-risk and functional assessment; consider geriatric consult", "Medium"),
    ("procedures", "Post-procedure", "Post-procedure wound/recovery check and symptom education", "Low"),
]
_RULE_ROWS = ", ".join(f"({i}, '{k}', '{c}', '{a}', '{p}')" for i, (k, c, a, p) in enumerate(RULES))
PLANS = f"""rules AS (SELECT * FROM (VALUES {_RULE_ROWS}) r(i, keyword, category, action, priority)),
hits AS (SELECT patient_id, i, category, action, priority FROM sc JOIN rules ON contains(lower(top_3_risk_factors), keyword)
  QUALIFY row_number() OVER (PARTITION BY patient_id, category ORDER BY i) = 1),
steps AS (SELECT * FROM hits UNION ALL SELECT patient_id, 99, 'Primary care', 'Schedule PCP follow-up within 7 days of discharge', CASE WHEN tier = 'High' THEN 'High' ELSE 'Medium' END FROM sc
  UNION ALL SELECT patient_id, -1, 'Escalation', 'Flag for intensive case management; daily check-ins for the first week', 'High' FROM sc WHERE tier = 'High')"""

STATUS = f"""log AS (SELECT CAST(patient_id AS BIGINT) AS patient_id, TRY_CAST(last_contacted AS DATE) AS last_contacted FROM fx_contact_log WHERE TRY_CAST(last_contacted AS DATE) IS NOT NULL),
st0 AS (SELECT sc.*, last_contacted, CASE tier WHEN 'High' THEN 7 WHEN 'Medium' THEN 30 ELSE 90 END AS cadence_days FROM sc LEFT JOIN log USING (patient_id)),
st AS (SELECT *, last_contacted + cadence_days AS next_due, CASE WHEN last_contacted IS NULL THEN 'New' WHEN last_contacted + cadence_days < DATE '2024-04-01' THEN 'Overdue'
  WHEN last_contacted + cadence_days = DATE '2024-04-01' THEN 'Due' ELSE 'Scheduled' END AS status FROM st0)"""
E_ = f"WITH {SCO}, {SCORED}, {LOG}, {STATUS} "
_EXPORT = "patient_id, risk_score, tier, top_3_risk_factors, probability, predicted_label"

CHECKS = {
    "d02_numeric_coercion": """SELECT CASE WHEN l_partkey % 3 = 0 THEN 9007199254740993 + l_orderkey ELSE l_orderkey END AS encounter_id,
        o_custkey AS patient_nbr, o_orderstatus AS readmitted,
        CASE l_suppkey % 9 WHEN 5 THEN CAST(7 AS DOUBLE) WHEN 7 THEN CAST(-5 AS DOUBLE) END AS num_procedures,
        CASE WHEN l_linenumber <= 2 THEN NULL WHEN l_linenumber = 3 THEN CAST(l_partkey AS DOUBLE) ELSE l_quantity END AS number_inpatient,
        CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_suppkey AS DOUBLE) END AS num_medications FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "d04_d06_d08_caps_on_all_rows": f"WITH {ADM}, {NULLED}, {KEPT} SELECT encounter_id, max_glu_serum, {_cap('kept', 0.9)} FROM kept",
    "d04_d11_cleaned_encounters": CLEANED + f"""SELECT encounter_id, patient_nbr, race, medical_specialty, diag_1, {", ".join(_CAPS)}, age_midpoint, change_flag,
        diabetes_med_flag, readmit_30d FROM cleaned""",
    "d12_provenance": CLEANED + """SELECT (SELECT count(*) FROM fx_admissions) AS rows_raw, (SELECT count(*) FROM kept) AS rows_after_exclusions,
        count(*) AS rows_after_dedup, count(*) AS rows_final, round_even(avg(readmit_30d), 4) AS positive_rate FROM cleaned""",
    "d14_icd9_groups": f"""SELECT k, n, {icd('code')} AS disease_group FROM (SELECT l_orderkey AS k, l_linenumber AS n, CASE l_partkey % 12 WHEN 0 THEN NULL WHEN 1 THEN ' '
        WHEN 2 THEN 'V45' WHEN 3 THEN 'E812' WHEN 4 THEN 'abc' WHEN 5 THEN 'nan' WHEN 6 THEN concat('250.', CAST(l_suppkey % 100 AS STRING))
        WHEN 7 THEN concat(' ', CAST(100 + l_partkey % 900 AS STRING), ' ') ELSE concat(CAST(l_orderkey % 1000 AS STRING), '.', CAST(l_suppkey % 10 AS STRING)) END AS code FROM lineitem)""",
    "d13_d18_feature_steps": f"""WITH {ADM} SELECT encounter_id, CAST(number_inpatient + number_emergency + number_outpatient AS BIGINT) AS num_prior_admissions,
        {icd('diag_1')} AS diag_1_group, {icd('diag_2')} AS diag_2_group, {icd('diag_3')} AS diag_3_group, {_ADMIN}, A1Cresult AS a1c_result,
        max_glu_serum AS max_glu_serum_grp, {_MEDS} FROM fx_admissions""",
    "d19_d20_collapsed_specialty": f"""WITH {ADM}, {NULLED}, l AS (SELECT medical_specialty AS m, count(*) AS n FROM nulled GROUP BY 1)
        SELECT CASE WHEN n < 0.01 * (SELECT sum(n) FROM l) THEN 'Other' ELSE coalesce(m, 'Unknown') END AS specialty, CAST(sum(n) AS BIGINT) AS encounters FROM l GROUP BY 1""",
    "d21_feature_table": F_ + "SELECT * FROM feats",
    "d22_class_counts": f"WITH {ADM} SELECT readmitted, count(*) AS encounters FROM fx_admissions GROUP BY 1",
    "d22_positive_rate": f"WITH {ADM} SELECT round_even(avg(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END) * 100, 2) AS positive_rate_pct FROM fx_admissions",
    "d22_missing_shares": f"WITH {ADM}, {NULLED} SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100, 2) AS missing_pct FROM nulled"
        for c in [*_TEXT, "admission_type_id", "discharge_disposition_id", "admission_source_id", "encounter_id", "patient_nbr", *_CAPS]) + ") WHERE missing_pct > 0",
    "d22_diagnosis_counts": F_ + "SELECT diag_1_group, count(*) AS patients FROM feats GROUP BY 1",
    "d22_score_histogram": S_ + """SELECT tier, least(CAST(floor((risk_score - lo) * 40 / CAST(hi - lo AS DOUBLE)) AS BIGINT), 39) AS bin, count(*) AS patients FROM (
        SELECT *, min(risk_score) OVER (PARTITION BY tier) AS lo, max(risk_score) OVER (PARTITION BY tier) AS hi FROM sc) GROUP BY 1, 2""",
    "d23_split": F_ + f", {FOLDED} SELECT patient_nbr, fold = 0 AS is_test FROM folded",
    "d27_class_weight": F_ + "SELECT round_even(CAST(count(*) FILTER (WHERE readmit_30d = 0) AS DOUBLE) / count(*) FILTER (WHERE readmit_30d = 1), 4) AS scale_pos_weight FROM feats",
    "d28_d31_metrics": f"WITH {SCO}, {MODELS} SELECT * FROM models",
    "d28_d31_metrics_by_group": f"WITH {SCO} " + full_metrics(metrics_sql(_BASE_SRC, group="subgroup"), "subgroup,"),
    "d32_champion": f"WITH {SCO}, {MODELS}, {CHAMP} SELECT model AS champion FROM champ",
    "d34_fold_sizes": F_ + f", {FOLDED} SELECT fold, readmit_30d, count(*) AS patients FROM folded GROUP BY 1, 2",
    "d35_d38_d41_scores": S_ + "SELECT patient_id, round_even(probability, 4) AS probability, risk_score, tier, predicted_label FROM sc",
    "d36_tier_cuts": S_ + "SELECT quantile_cont(CAST(risk_score AS DOUBLE), 0.5) AS medium_cut, quantile_cont(CAST(risk_score AS DOUBLE), 0.8) AS high_cut FROM sc",
    "d37_supplied_cuts": S_ + "SELECT CASE WHEN risk_score >= 75 THEN 'High' WHEN risk_score >= 40 THEN 'Medium' ELSE 'Low' END AS tier, count(*) AS patients FROM sc GROUP BY 1",
    "d39_tier_summary": S_ + f"SELECT * FROM {_tsum('sc')}",
    "d40_exact_percentages": S_ + f"SELECT * FROM {largest_remainder('(SELECT subgroup, count(*) AS patients FROM sc GROUP BY 1)', 'subgroup')}",
    "d42_score_export": S_ + f"SELECT {_EXPORT} FROM sc",
    "d43_d44_contributions": C_ + "SELECT patient_nbr, feature, round(v, 6) AS contribution FROM contrib",
    "d45_top_factors": C_ + """SELECT patient_nbr, coalesce(string_agg(concat(label, ': ', pv), '; ' ORDER BY rk) FILTER (WHERE v > 0 AND rk <= 3), 'no elevated risk factors') AS top_3_risk_factors
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_nbr ORDER BY v DESC, ord) AS rk FROM contrib) GROUP BY patient_nbr""",
    "d46_global_drivers": C_ + _IMPORTANCE,
    "d47_one_patient_drivers": C_ + """SELECT feature, label, round(v, 6) AS contribution, pv AS patient_value FROM contrib
        WHERE patient_nbr = (SELECT max(patient_nbr) FROM feats) ORDER BY abs(v) DESC, feature LIMIT 4""",
    "d48_threshold_sweep": W_ + "SELECT * FROM sw",
    "d49_recommended_threshold": W_ + "SELECT *, CAST(fn * 10 + fp AS DOUBLE) AS total_cost FROM sw ORDER BY total_cost, threshold LIMIT 1",
    "d50_nearest_threshold": W_ + "SELECT * FROM sw WHERE threshold = 0.5",
    "d51_scores_with_labels": FS_ + "SELECT patient_id, probability, readmit_30d AS y_true FROM sc JOIN feats ON patient_id = patient_nbr",
    "d52_d53_d55_subgroups": A_ + "SELECT * FROM subs",
    "d53_subgroups_of_scores": f"WITH {SCO}, {SCORED}, {SEG} SELECT * FROM {_subs('seg')}",
    "d54_fairness_gaps": A_ + "SELECT * FROM gapt",
    "d56_d57_patient_level": FS_ + """SELECT patient_id, risk_score, tier, predicted_label, CAST(readmit_30d AS DOUBLE) AS actual_readmit_30d,
        CASE WHEN predicted_label = readmit_30d THEN 1 ELSE 0 END AS prediction_correct, CASE WHEN predicted_label = 1 AND readmit_30d = 1 THEN 'True Positive'
        WHEN predicted_label = 1 AND readmit_30d = 0 THEN 'False Positive' WHEN predicted_label = 0 AND readmit_30d = 1 THEN 'False Negative' ELSE 'True Negative' END AS outcome_quadrant,
        CASE WHEN age_midpoint IS NULL THEN 'Unknown' WHEN age_midpoint < 50 THEN '<50' WHEN age_midpoint < 70 THEN '50-69' ELSE '70+' END AS age_band,
        diag_1_group, num_prior_admissions FROM sc LEFT JOIN feats ON patient_id = patient_nbr""",
    "d58_observed_tier_summary": FS_ + f"""SELECT * FROM {_tsum("(SELECT sc.*, readmit_30d FROM sc LEFT JOIN feats ON patient_id = patient_nbr)", ", round_even(avg(readmit_30d), 4) AS actual_readmit_rate")}""",
    "d59_fairness_long": A_ + f"SELECT * FROM subs UNION ALL SELECT * FROM {_subs('seg')}",
    "d60_model_metrics": f"WITH {SCO}, {MODELS}, {CHAMP} SELECT model, model = (SELECT model FROM champ) AS is_champion, auroc, pr_auc, recall, precision, f1, brier FROM models",
    "d62_care_plan_steps": f"{S_.rstrip()}, {PLANS} SELECT patient_id, CAST(row_number() OVER (PARTITION BY patient_id ORDER BY CASE priority WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END, i) AS INT) AS step, category, action, priority FROM steps",
    "d62_care_plan_summaries": S_ + """SELECT patient_id, concat(tier, '-risk patient (score ', CAST(risk_score AS STRING), '/100). Key drivers: ', top_3_risk_factors,
        '. Plan targets the top modifiable readmission drivers with a structured 30-day transition.') AS summary FROM sc""",
    "e01_contact_log": E_ + "SELECT patient_id, CAST(last_contacted AS STRING) AS last_contacted FROM log",
    "e02_upsert_contacts": E_ + """SELECT patient_id, CAST(last_contacted AS STRING) AS last_contacted FROM log WHERE patient_id NOT IN (SELECT patient_id FROM sc WHERE probability >= 0.9)
        UNION ALL SELECT patient_id, '2024-04-01' FROM sc WHERE probability >= 0.9""",
    "e03_due_status": E_ + "SELECT patient_id, tier, status, cadence_days, CAST(last_contacted AS STRING) AS last_contacted, CAST(next_due AS STRING) AS next_due FROM st",
    "e04_queue_counts": E_ + """SELECT count(*) FILTER (WHERE status <> 'Scheduled') AS due_today, count(*) FILTER (WHERE status = 'Overdue') AS overdue,
        count(*) FILTER (WHERE status = 'New') AS never_contacted, count(*) FILTER (WHERE status = 'Scheduled') AS scheduled FROM st""",
    "e05_outreach_queue": E_ + """SELECT patient_id, risk_score, tier, status, CAST(last_contacted AS STRING) AS last_contacted, CAST(next_due AS STRING) AS next_due, top_3_risk_factors AS why
        FROM st WHERE status <> 'Scheduled' ORDER BY CASE status WHEN 'Overdue' THEN 0 WHEN 'New' THEN 1 ELSE 2 END, risk_score DESC, patient_id LIMIT 200""",
    "e06_tier_counts": S_ + "SELECT * FROM " + largest_remainder(
        "(" + " UNION ALL ".join(f"SELECT {i} AS position, '{t}' AS tier, count(*) FILTER (WHERE tier = '{t}') AS patients FROM sc" for i, t in enumerate(["High", "Medium", "Low"])) + ")", "position"),
    "e07_score_bands": S_ + "SELECT band, lo, patients, pct_of_panel FROM " + largest_remainder(
        """(SELECT lo, concat(CAST(lo AS STRING), '-', CAST(lo + 5 AS STRING)) AS band, (SELECT count(*) FROM sc WHERE risk_score >= lo AND risk_score < lo + 5) AS patients
        FROM (SELECT unnest(range(0, 100, 5)) AS lo))""", "lo"),
    "e08_filtered_explorer": S_ + f"SELECT {_EXPORT} FROM sc WHERE tier IN ('High', 'Medium') AND risk_score BETWEEN 55 AND 90 ORDER BY risk_score DESC, patient_id LIMIT 1000",
    "e09_pick_list": S_ + "SELECT patient_id, risk_score FROM sc ORDER BY risk_score DESC, patient_id LIMIT 500",
    "e09_pick_list_of_empty_view": S_ + "SELECT patient_id, risk_score FROM sc ORDER BY risk_score DESC, patient_id LIMIT 100",
    "e09_patient_card": S_ + f"SELECT {_EXPORT} FROM sc ORDER BY risk_score DESC, patient_id LIMIT 1",
    "e10_headline": S_ + """SELECT count(*) AS patients, count(*) FILTER (WHERE tier = 'High') AS high_risk, round_even(CAST(count(*) FILTER (WHERE tier = 'High') AS DOUBLE) / count(*) * 100, 1)
        AS high_risk_pct, round(avg(risk_score), 6) AS mean_score FROM sc""",
    "e11_precision_recall_points": W_ + """SELECT threshold, recall, precision, round_even((recall - (SELECT recall FROM sw WHERE threshold = 0.5)) * 100, 2) AS recall_change_pts,
        threshold = (SELECT threshold FROM sw ORDER BY fn * 10 + fp, threshold LIMIT 1) AS recommended FROM sw WHERE precision IS NOT NULL""",
    "e12_champion_confusion": f"WITH {SCO}, {MODELS}, {CHAMP} SELECT model, tp AS correctly_flagged, fn AS missed, fp AS false_alarms, tn AS correctly_cleared FROM models WHERE model = (SELECT model FROM champ)",
    "e12_top_three_drivers": C_ + f"SELECT label FROM ({_IMPORTANCE}) ORDER BY relative_influence DESC, feature LIMIT 3",
    "e13_group_view": A_ + """SELECT attribute, subgroup AS "group", n AS patients, positive_rate AS actual_readmit_rate, auroc AS ranking_quality, recall_tpr AS high_risk_caught,
        fnr AS high_risk_missed, selection_rate AS flagged_rate FROM subs""",
    "e13_fairness_statement": A_ + """SELECT attribute, equal_opportunity_diff, demographic_parity_diff, 'The model misses the most readmissions in the ' || worst_fnr_subgroup ||
        ' group - about ' || CAST(CAST(round_even(worst_fnr * 100, 0) AS INT) AS STRING) || '% go unflagged.' AS statement FROM gapt""",
}
