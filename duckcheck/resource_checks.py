"""DuckDB twins for the clinical-resource queries."""

from carepanel.sources.fixture_views import duck_cte

AS_OF = "DATE '2024-04-01'"

LABS = {
    "hba1c": "4548-4", "creatinine": "2160-0", "sodium": "2951-2",
    "hemoglobin": "718-7", "systolic_bp": "8480-6", "bmi": "39156-5",
}
GROUPS = {
    "diabetes": "E10|E11|E13", "heart_failure": "I50", "copd": "J43|J44", "ckd": "N18",
    "hypertension": "I10|I11|I12|I13", "coronary_artery_disease": "I25", "atrial_fibrillation": "I48",
    "depression": "F32|F33", "cancer": "C", "stroke": "I63|I64",
}

CONDS = """conds AS (SELECT patient_id, CAST(count(*) FILTER (WHERE clinical_status = 'active') AS INT) AS num_active_conditions,
  CAST(count(*) AS INT) AS num_total_conditions, """ + ", ".join(
    f"CAST(max(CASE WHEN regexp_matches(code, '^({p})') THEN 1 ELSE 0 END) AS INT) AS has_{n}" for n, p in GROUPS.items()
) + " FROM fx_conditions GROUP BY patient_id)"

TOP_OBS = """top_obs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY effective_date DESC, seq) AS rk
  FROM fx_observations) WHERE rk <= 50)"""

LAB_ROWS = """lab_rows AS (SELECT patient_id, loinc_code, TRY_CAST(value_text AS DOUBLE) AS v, interpretation AS i FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id, loinc_code ORDER BY effective_date DESC, seq) AS r2
  FROM top_obs WHERE value_text IS NOT NULL AND effective_date <> '') WHERE r2 = 1)"""

LAB_WIDE = "lab_wide AS (SELECT patient_id, " + ", ".join(
    f"max(CASE WHEN loinc_code = '{c}' THEN v END) AS {n}, max(CASE WHEN loinc_code = '{c}' THEN i END) AS {n}_i" for n, c in LABS.items()
) + " FROM lab_rows GROUP BY patient_id)"


def _mark(lab, m):
    return f"CAST(CASE WHEN {lab}_i = '' THEN NULL WHEN {lab}_i = '{m}' THEN 1 WHEN {lab}_i IS NOT NULL THEN 0 END AS INT)"


LABF = f"""labf AS (SELECT patient_id, hba1c AS hba1c_value, {_mark('hba1c', 'H')} AS hba1c_abnormal, CAST(hba1c > 8 AS INT) AS hba1c_poor_control,
  creatinine AS creatinine_value, {_mark('creatinine', 'H')} AS creatinine_abnormal, sodium AS sodium_value, {_mark('sodium', 'L')} AS sodium_low,
  hemoglobin AS hemoglobin_value, {_mark('hemoglobin', 'L')} AS anemia_flag, systolic_bp, CAST(systolic_bp >= 180 AS INT) AS hypertensive_urgency,
  bmi, CAST(bmi >= 30 AS INT) AS obese FROM lab_wide)"""

ENC = """encf AS (SELECT patient_id, CAST(count(*) AS INT) AS total_encounters_ever,
  CAST(sum(ip) AS INT) AS num_inpatient_encounters, CAST(sum(ed) AS INT) AS num_ed_encounters,
  round_even(avg(CASE WHEN ip = 1 THEN CAST(length_of_stay_days AS DOUBLE) END), 1) AS avg_length_of_stay,
  CAST(max(CASE WHEN ip = 1 AND length_of_stay_days IS NOT NULL THEN CASE WHEN length_of_stay_days > 7 THEN 1 ELSE 0 END END) AS INT) AS long_stay_history
  FROM (SELECT *, CASE WHEN upper(class_code) IN ('IMP','INPATIENT','I') THEN 1 ELSE 0 END AS ip,
               CASE WHEN upper(class_code) IN ('EMER','EMERGENCY','ED','E') THEN 1 ELSE 0 END AS ed,
               row_number() OVER (PARTITION BY patient_id ORDER BY start_date DESC, encounter_id) AS rk FROM fx_encounters) WHERE rk <= 50
  GROUP BY patient_id)"""

MEDS = """meds AS (SELECT patient_id, CAST(least(count(*), 100) AS INT) AS num_active_medications FROM fx_medications
  WHERE status = 'active' GROUP BY patient_id)"""

PATS = f"""pats AS (SELECT *, CAST(datesub('year', birth_date, {AS_OF}) AS INT) AS age FROM fx_patients)"""

_HAS = [f"has_{n}" for n in GROUPS]
_ZERO = ["num_active_conditions", "num_total_conditions", *_HAS, "num_active_medications", "total_encounters_ever",
         "num_inpatient_encounters", "num_ed_encounters"]

FEATURES = f"""joined AS (SELECT p.patient_id, p.state, p.gender, p.age, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _ZERO)},
  hba1c_value, hba1c_abnormal, hba1c_poor_control, creatinine_value, creatinine_abnormal, sodium_value, sodium_low, hemoglobin_value,
  anemia_flag, systolic_bp, hypertensive_urgency, bmi, obese, avg_length_of_stay, long_stay_history
  FROM pats p LEFT JOIN conds USING (patient_id) LEFT JOIN labf USING (patient_id) LEFT JOIN meds USING (patient_id) LEFT JOIN encf USING (patient_id)),
feat AS (SELECT substr(sha256(patient_id), 1, 16) AS patient_token, * EXCLUDE (patient_id, gender),
  CAST(gender = 'female' AS INT) AS gender_female, CAST(gender = 'male' AS INT) AS gender_male,
  CAST(age >= 65 AS INT) AS age_over_65, CAST(age >= 80 AS INT) AS age_over_80,
  CAST(num_active_conditions >= 3 AS INT) AS high_comorbidity_burden, CAST(num_active_medications >= 5 AS INT) AS polypharmacy,
  CAST(num_inpatient_encounters >= 3 AS INT) AS high_utilizer,
  CAST(CASE WHEN hba1c_poor_control IS NOT NULL THEN CASE WHEN has_diabetes = 1 AND hba1c_poor_control = 1 THEN 1 ELSE 0 END END AS INT) AS uncontrolled_diabetes,
  CAST(CASE WHEN anemia_flag IS NOT NULL THEN CASE WHEN has_heart_failure = 1 AND anemia_flag = 1 THEN 1 ELSE 0 END END AS INT) AS heart_failure_with_anemia,
  CAST(coalesce(hba1c_abnormal, 0) + coalesce(creatinine_abnormal, 0) + coalesce(sodium_low, 0) + coalesce(anemia_flag, 0) AS INT) AS num_abnormal_labs
  FROM joined),
scored AS (SELECT *, CASE WHEN risk_score <= 30 THEN 'LOW' WHEN risk_score <= 60 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_tier FROM (
  SELECT *, CAST(least(100, least(num_inpatient_encounters * 15, 30) + least(num_ed_encounters * 5, 15) + high_comorbidity_burden * 10
    + has_heart_failure * 15 + has_copd * 10 + has_ckd * 10 + coalesce(uncontrolled_diabetes, 0) * 12 + polypharmacy * 8
    + num_abnormal_labs * 8 + coalesce(age_over_80, 0) * 10 + coalesce(age_over_65, 0) * 5) AS INT) AS risk_score FROM feat))"""

_VIEWS = ", ".join(duck_cte(v) for v in ("patients", "conditions", "observations", "encounters", "medications"))
ALL = f"WITH {_VIEWS}, {CONDS}, {TOP_OBS}, {LAB_ROWS}, {LAB_WIDE}, {LABF}, {ENC}, {MEDS}, {PATS}, {FEATURES} "


def _with(*names, extra=()):
    return "WITH " + ", ".join([*(duck_cte(n) for n in names), *extra]) + " "


def doubles(*cols):
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"


LAB_FLAGS = ("hba1c_abnormal", "hba1c_poor_control", "creatinine_abnormal", "sodium_low", "anemia_flag", "hypertensive_urgency", "obese")


def _stack(rows):
    return " UNION ALL ".join(f"SELECT {r} FROM scored" for r in rows)


_GRADE = "CASE WHEN p >= {ok} THEN 'pass' WHEN p >= {warn} THEN 'warn' ELSE 'fail' END"


def _complete():
    parts = []
    for group, cols, ok, warn in (
        ("critical", ["age", "num_active_conditions", "num_inpatient_encounters", "num_ed_encounters"], 90, 70),
        ("lab", ["hba1c_value", "creatinine_value", "sodium_value", "hemoglobin_value", "systolic_bp"], 70, 40),
    ):
        for c in cols:
            parts.append(
                f"SELECT '{group}' AS feature_group, '{c}' AS feature, n AS non_null, t AS total, p AS pct_complete, "
                f"{_GRADE.format(ok=ok, warn=warn)} AS grade FROM (SELECT count({c}) AS n, count(*) AS t, "
                f"round_even(count({c}) * CAST(100 AS DOUBLE) / count(*), 1) AS p FROM scored)"
            )
    return ALL + " UNION ALL ".join(parts)


_COND_BASE = """base AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_linestatus AS ls, o_custkey AS c, CAST(CAST(l_shipdate AS DATE) AS STRING) AS onset
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_CODINGS = """SELECT CASE WHEN k % 41 = 3 THEN NULL ELSE CAST(c AS STRING) END AS patient_id, concat(CAST(k AS STRING), '-', CAST(n AS STRING)) AS condition_id,
  {code} AS code, {display} AS display, {system} AS system, CASE WHEN ls = 'O' THEN 'active' ELSE 'unknown' END AS clinical_status, onset AS onset_date
  FROM base WHERE k % 97 <> 5 AND k % 50 <> 7 AND {which}"""

CHECKS = {
    "a01_a25_scan_and_quarantine": """SELECT outcome, count(*) AS records FROM (SELECT CASE WHEN l_orderkey % 97 = 5 THEN 'quarantined'
        WHEN l_orderkey % 50 = 7 THEN 'Patient' ELSE 'Condition' END AS outcome FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""",
    "a25_failed_records": """SELECT reason, path, resource_type, names_patient, count(*) AS records FROM (
        SELECT CASE WHEN l_orderkey % 97 = 5 THEN 'syntax' ELSE 'wrong resource' END AS reason, CAST(NULL AS VARCHAR) AS path,
        CASE WHEN l_orderkey % 97 = 5 THEN 'Condition' ELSE 'Patient' END AS resource_type,
        CASE WHEN l_orderkey % 97 = 5 THEN false ELSE l_orderkey % 41 <> 3 END AS names_patient
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 97 = 5 OR l_orderkey % 50 = 7) GROUP BY ALL""",
    "a25_failed_patients": """WITH src AS (SELECT l_orderkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        failed AS (SELECT DISTINCT o_custkey FROM src WHERE l_orderkey % 97 <> 5 AND l_orderkey % 50 = 7 AND l_orderkey % 41 <> 3)
        SELECT (SELECT count(*) FROM failed) AS failed_patients, (SELECT count(*) FROM src WHERE l_orderkey % 97 <> 5 AND l_orderkey % 50 <> 7
        AND l_orderkey % 41 <> 3 AND o_custkey IN (SELECT o_custkey FROM failed)) AS records_set_aside""",
    "a02_cohort_semi_join": _with("patients", "conditions")
    + "SELECT patient_id, state FROM fx_patients WHERE patient_id IN (SELECT patient_id FROM fx_conditions)",
    "a02_cohort_first_seen": _with("conditions")
    + "SELECT patient_id FROM (SELECT patient_id, min(condition_id) AS f FROM fx_conditions GROUP BY 1) ORDER BY f, patient_id LIMIT 20",
    "a03_condition_codings": f"WITH {_COND_BASE} "
    + _CODINGS.format(code="concat('E', CAST(p % 90 AS STRING))", display="'first'", system="'icd10'", which="p % 3 IN (1, 2)")
    + " UNION ALL " + _CODINGS.format(code="'73211009'", display="''", system="'snomed'", which="p % 3 = 2"),
    "a04_a06_a15_observation_values": """SELECT CAST(user_id AS STRING) AS patient_id, CAST(event_id AS STRING) AS observation_id,
        CASE event_id % 4 WHEN 0 THEN '4548-4' WHEN 1 THEN '718-7' ELSE '' END AS loinc_code,
        CASE event_id % 4 WHEN 0 THEN 'HbA1c' WHEN 1 THEN 'Hgb' ELSE '' END AS display,
        CASE event_id % 5 WHEN 0 THEN CAST(CAST(event_id % 80 AS DOUBLE) / 8 AS STRING) WHEN 2 THEN 'positive' WHEN 3 THEN '12.5' END AS value_text,
        CASE event_id % 5 WHEN 0 THEN '%' WHEN 1 THEN 'mg' ELSE '' END AS unit,
        CASE WHEN event_id % 3 = 0 THEN 'H' ELSE '' END AS interpretation, CAST(CAST(ts AS DATE) AS STRING) AS effective_date,
        CASE event_id % 5 WHEN 0 THEN CAST(event_id % 80 AS DOUBLE) / 8 WHEN 3 THEN 12.5 END AS value_num
        FROM events WHERE event_id % 211 <> 5""",
    "a07_latest_observations": _with("observations", extra=[TOP_OBS]) + "SELECT patient_id, seq, loinc_code, effective_date FROM top_obs",
    "a07_latest_observations_by_code": _with("observations")
    + """SELECT patient_id, seq, loinc_code FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY effective_date DESC, seq) AS rk
         FROM fx_observations WHERE loinc_code IN ('4548-4', '39156-5')) WHERE rk <= 5""",
    "a08_length_of_stay": """SELECT CAST(o_custkey AS STRING) AS patient_id, CAST(k AS STRING) AS encounter_id, CASE WHEN k % 2 = 0 THEN 'finished' ELSE '' END AS status,
        CASE WHEN k % 5 > 0 THEN 'IMP' ELSE 'unknown' END AS class_code,
        concat(CAST(d AS STRING), 'T', lpad(CAST(k % 24 AS STRING), 2, '0'), ':00:00', CASE k % 6 WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' WHEN 4 THEN 'Z' ELSE '' END) AS start_date,
        CASE k % 6 WHEN 3 THEN '' WHEN 5 THEN substr(CAST(d AS STRING), 1, 7) ELSE concat(CAST(d + CAST((k * 13) % 15 AS INT) AS STRING), 'T',
             lpad(CAST((k * 7) % 24 AS STRING), 2, '0'), ':00:00', CASE k % 6 WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' ELSE '' END) END AS end_date,
        CASE WHEN k % 6 IN (0, 1, 2) THEN floor((((k * 13) % 15) * 24 + (k * 7) % 24 - k % 24) / CAST(24 AS DOUBLE)) END AS length_of_stay_days
        FROM (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "a09_latest_encounters": _with("encounters")
    + """SELECT patient_id, encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start_date DESC, encounter_id) AS rk
         FROM fx_encounters) WHERE rk <= 10""",
    "a10_active_medications": _with("medications", extra=[MEDS]) + "SELECT * FROM meds",
    "a11_a12_patient_flatten_age": f"""SELECT CAST(c AS STRING) AS patient_id, CASE WHEN c % 13 > 0 THEN c_name ELSE '' END AS family_name,
        CASE WHEN c % 13 > 0 AND c % 3 <> 0 THEN 'Pat' ELSE '' END AS given_name, coalesce(b, '') AS date_of_birth,
        CAST(datesub('year', TRY_CAST(CASE WHEN length(b) = 10 THEN b END AS DATE), {AS_OF}) AS DOUBLE) AS age,
        CASE WHEN c % 11 = 0 THEN 'unknown' WHEN c % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
        CASE WHEN c % 7 > 0 THEN n_name ELSE '' END AS state, CASE WHEN c % 7 > 0 THEN CAST(10000 + c AS STRING) ELSE '' END AS zip_code,
        CASE WHEN c % 5 = 0 THEN '' ELSE '555-0100' END AS phone
        FROM (SELECT c_custkey AS c, c_name, n_name, CASE c_custkey % 9 WHEN 0 THEN '1950' WHEN 1 THEN '2001-02-30' WHEN 2 THEN '1964-02-29' WHEN 3 THEN NULL
              ELSE CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 31000 AS INT) AS STRING) END AS b
              FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "a13_a17_condition_burden": _with("conditions", extra=[CONDS]) + "SELECT * FROM conds",
    "a14_a18_latest_lab_flags": _with("observations", extra=[TOP_OBS, LAB_ROWS, LAB_WIDE, LABF]) + f"SELECT {doubles(*LAB_FLAGS)} FROM labf",
    "a16_demographic_flags": _with("patients", extra=[PATS])
    + """SELECT patient_id, age, CAST(gender = 'female' AS INT) AS gender_female, CAST(gender = 'male' AS INT) AS gender_male,
         CAST(age >= 65 AS INT) AS age_over_65, CAST(age >= 80 AS INT) AS age_over_80 FROM pats""",
    "a20_encounter_use": _with("encounters", extra=[ENC]) + f"SELECT {doubles('long_stay_history')} FROM encf",
    "a19_a21_a24_a31_a32_patient_features": ALL
    + f"SELECT {doubles(*LAB_FLAGS, 'long_stay_history', 'uncontrolled_diabetes', 'heart_failure_with_anemia')} FROM scored",
    "a22_patient_features_of_all_records": ALL.replace("WHERE rk <= 50", "").replace("least(count(*), 100)", "count(*)")
    + f"SELECT {doubles(*LAB_FLAGS, 'long_stay_history', 'uncontrolled_diabetes', 'heart_failure_with_anemia')} FROM scored",
    "a23_pseudonyms": _with("patients") + "SELECT patient_id, substr(sha256(patient_id), 1, 16) AS patient_token FROM fx_patients",
    "a26_completeness": _complete(),
    "a27_validity": ALL + _stack(
        f"'{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations, count(*) FILTER (WHERE {c}) = 0 AS passed"
        for n, c in (("age_outside_0_120", "age < 0 OR age > 120"), ("hba1c_outside_3_20", "hba1c_value < 3 OR hba1c_value > 20"),
                     ("negative_inpatient_count", "num_inpatient_encounters < 0"))
    ),
    "a28_distribution": ALL + """SELECT avg(age) AS age_mean, CAST(median(age) AS DOUBLE) AS age_median, min(age) AS age_min, max(age) AS age_max,
        avg(num_active_conditions) AS active_conditions_mean, max(num_active_conditions) AS active_conditions_max FROM scored""",
    "a29_prevalence": ALL + _stack(f"'{n}' AS condition, avg(has_{n}) * 100 AS prevalence_pct" for n in GROUPS),
    "a30_risk_indicators": ALL + _stack(
        f"'{c}' AS indicator, CAST(coalesce(sum({c}), 0) AS BIGINT) AS patients, coalesce(sum({c}), 0) * CAST(100 AS DOUBLE) / count(*) AS pct_of_total"
        for c in ("high_utilizer", "high_comorbidity_burden", "uncontrolled_diabetes")
    ),
    "a33_tier_counts": ALL + "SELECT risk_tier, count(*) AS patients FROM scored GROUP BY 1",
    "a33_top_three": ALL + """SELECT patient_token, risk_score, risk_tier, num_inpatient_encounters, has_heart_failure, num_abnormal_labs
        FROM scored ORDER BY risk_score DESC, patient_token LIMIT 3""",
    "a35_sample_projection": ALL + """SELECT patient_token, age, gender_female, num_active_conditions, has_diabetes, hba1c_value,
        num_inpatient_encounters, high_utilizer, high_comorbidity_burden FROM scored ORDER BY patient_token LIMIT 3""",
}
