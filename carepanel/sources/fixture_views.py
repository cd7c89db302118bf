"""Healthcare-shaped views over the given TPC-H-like tables.

Each text is valid in Spark SQL and in DuckDB. Table names are written as ``{table}``: Spark fills
them with DataFrames, the DuckDB checks with plain view names. Every view reads its tables whole.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

PATIENTS = """
SELECT CAST(c_custkey AS STRING) AS patient_id, c_name AS family_name, 'Pat' AS given_name,
       DATE '1930-01-01' + CAST((c_custkey * 7919) % 31000 AS INT) AS birth_date,
       CASE WHEN c_custkey % 11 = 0 THEN 'unknown' WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       n_name AS state, CAST(10000 + c_custkey AS STRING) AS zip_code, '555-0100' AS phone
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

CONDITIONS = """
SELECT CAST(o_custkey AS STRING) AS patient_id,
       concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS condition_id,
       CASE l_partkey % 16 WHEN 0 THEN 'E11.9' WHEN 1 THEN 'I50.9' WHEN 2 THEN 'J44.1' WHEN 3 THEN 'N18.3'
            WHEN 4 THEN 'I10' WHEN 5 THEN 'I25.10' WHEN 6 THEN 'I48.0' WHEN 7 THEN 'F32.1' WHEN 8 THEN 'C50.9'
            WHEN 9 THEN 'I63.9' WHEN 10 THEN 'E10.1' ELSE '73211009' END AS code,
       CASE WHEN l_linestatus = 'O' THEN 'active' WHEN l_returnflag = 'R' THEN 'unknown' ELSE 'resolved' END AS clinical_status,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS onset_date
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

OBSERVATIONS = """
SELECT CAST(user_id AS STRING) AS patient_id, event_id AS seq,
       CASE event_id % 9 WHEN 0 THEN '4548-4' WHEN 1 THEN '2345-7' WHEN 2 THEN '2160-0' WHEN 3 THEN '2951-2'
            WHEN 4 THEN '718-7' WHEN 5 THEN '8480-6' WHEN 6 THEN '8462-4' WHEN 7 THEN '8867-4' ELSE '39156-5' END AS loinc_code,
       CAST(CASE WHEN event_id % 37 = 0 THEN NULL
            WHEN event_id % 9 = 0 THEN 4 + CAST(event_id % 80 AS DOUBLE) / 10
            WHEN event_id % 9 = 2 THEN CAST(5 + event_id % 20 AS DOUBLE) / 10
            WHEN event_id % 9 = 5 THEN CAST(90 + event_id % 120 AS DOUBLE)
            ELSE CAST(15 + event_id % 30 AS DOUBLE) END AS STRING) AS value_text,
       CASE event_id % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'L' WHEN 2 THEN 'N' ELSE '' END AS interpretation,
       CAST(CAST(ts AS DATE) AS STRING) AS effective_date
FROM {events} e
"""

ENCOUNTERS = """
SELECT patient_id, encounter_id, class_code, start_date,
       CAST(start_date + stay AS STRING) AS end_date, stay AS length_of_stay_days
FROM (SELECT CAST(o_custkey AS STRING) AS patient_id, o_orderkey AS encounter_id,
             CASE o_orderkey % 4 WHEN 0 THEN 'IMP' WHEN 1 THEN 'EMER' WHEN 2 THEN 'AMB' ELSE 'inpatient' END AS class_code,
             CAST(o_orderdate AS DATE) AS start_date,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST((o_orderkey * 13) % 15 AS INT) END AS stay
      FROM {orders} o) x
"""

MEDICATIONS = """
SELECT CAST(o_custkey AS STRING) AS patient_id, l_partkey AS medication_id,
       CASE WHEN l_returnflag = 'N' THEN 'active' ELSE 'stopped' END AS status
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

NOTES = """
SELECT doc_id AS note_id, concat(
   'CHIEF COMPLAINTS:', chr(10), CASE doc_id % 4 WHEN 0 THEN 'Chest pain.' WHEN 1 THEN 'Denies chest pain.'
        WHEN 2 THEN 'Possible heart failure.' ELSE 'Shortness of breath.' END, chr(10),
   'PAST MEDICAL HISTORY:', chr(10), CASE doc_id % 5 WHEN 0 THEN '1. History of type 2 diabetes'
        WHEN 1 THEN '1. No known coronary artery disease' WHEN 2 THEN '1. Hypertension'
        WHEN 3 THEN '1. Chronic kidney disease' ELSE '1. COPD' END, chr(10),
   'MEDICATIONS ON ADMISSION:', chr(10), CASE doc_id % 3 WHEN 0 THEN '1. Metformin 1000mg twice daily'
        WHEN 1 THEN '2. Lisinopril 10mg daily' ELSE 'Aspirin tablet' END, chr(10),
   CASE doc_id % 7 WHEN 0 THEN 'Warfarin 2.5mg' WHEN 3 THEN 'Oxygen at home' ELSE 'insulin 10 units BID' END, chr(10),
   'HPI:', chr(10), CASE doc_id % 6 WHEN 0 THEN 'Patient lives alone.'
        WHEN 1 THEN 'Unable to afford medication. Referred to cardiology. Referral placed to o''brien''s wound-care team.'
        WHEN 2 THEN 'Smoking history. Consult placed for nephrology.'
        WHEN 3 THEN 'Homeless, no transportation. Referred to social work. Referred to social work.'
        WHEN 4 THEN 'Stopped taking metformin.' ELSE 'No acute distress. Type 2 diabetes noted.' END, chr(10),
   text, chr(10), 'FOLLOW-UP:', chr(10), 'Primary Care within ', CAST(doc_id % 14 AS STRING), ' days', chr(10),
   CASE WHEN doc_id % 9 = 0 THEN concat('PMH:', chr(10), '1. Atrial fibrillation', chr(10)) ELSE '' END) AS note_text
FROM {documents} d
"""

POPULATION = """
SELECT concat('PT', lpad(CAST(k AS STRING), 8, '0')) AS patient_token, age, gender, insurance, race,
       has_diabetes, has_hypertension, has_heart_disease, has_copd, has_ckd, has_cancer_history, has_depression,
       CASE WHEN has_diabetes = 1 THEN CAST(55 + (k * 29) % 80 AS DOUBLE) / 10 ELSE CAST(45 + (k * 29) % 20 AS DOUBLE) / 10 END AS hba1c,
       CAST(95 + (k * 31) % 90 AS INT) AS systolic_bp, CAST(55 + (k * 37) % 55 AS INT) AS diastolic_bp,
       CAST(40 + (k * 41) % 180 AS INT) AS ldl, CAST(160 + (k * 43) % 390 AS DOUBLE) / 10 AS bmi,
       CAST((k * 47) % 4 AS INT) AS ed_visits_12m,
       CASE WHEN (k * 53) % 10 >= 8 THEN 2 WHEN (k * 53) % 10 = 7 THEN 1 ELSE 0 END AS inpatient_admits_12m,
       CAST((k * 59) % 9 AS INT) AS pcp_visits_12m,
       CASE WHEN has_diabetes = 0 THEN 9999 ELSE CASE (k * 61) % 5 WHEN 0 THEN 30 WHEN 1 THEN 180 WHEN 2 THEN 365 WHEN 3 THEN 548 ELSE 90 END END AS days_since_hba1c,
       CASE WHEN age BETWEEN 45 AND 75 AND k % 3 = 0 THEN 1 ELSE 0 END AS colonoscopy_due,
       CASE WHEN gender = 'F' AND age BETWEEN 50 AND 74 AND k % 4 = 0 THEN 1 ELSE 0 END AS mammogram_due,
       CASE WHEN k % 7 < 5 THEN 1 ELSE 0 END AS statin_flag,
       CASE WHEN has_diabetes = 1 THEN CAST(30 + (k * 67) % 71 AS DOUBLE) / 100 ELSE CAST(1 AS DOUBLE) END AS diabetes_med_pdc,
       CASE WHEN has_hypertension = 1 THEN CAST(30 + (k * 71) % 71 AS DOUBLE) / 100 ELSE CAST(1 AS DOUBLE) END AS htn_med_pdc,
       CAST(k % 2 AS INT) AS awv_completed, CAST((k * 73) % 3 % 2 AS INT) AS mychart_enrolled,
       CASE k % 4 WHEN 0 THEN 'Phone' WHEN 1 THEN 'Text' WHEN 2 THEN 'Email' ELSE 'Portal' END AS contact_preference,
       CASE WHEN (k * 79) % 7 = 0 THEN 1 ELSE 0 END AS transportation_barrier, CASE WHEN (k * 83) % 8 = 0 THEN 1 ELSE 0 END AS food_insecurity,
       CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END AS housing_instability, CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS social_isolation,
       CASE (k * 89) % 7 WHEN 0 THEN 30 WHEN 1 THEN 90 WHEN 2 THEN 180 WHEN 3 THEN 365 WHEN 4 THEN 548 WHEN 5 THEN 730 ELSE 9999 END AS last_pcp_visit_days
FROM (SELECT c_custkey AS k, CAST(18 + (c_custkey * 17) % 78 AS INT) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        CASE WHEN 18 + (c_custkey * 17) % 78 >= 65 THEN CASE WHEN c_custkey % 9 < 5 THEN 'Medicare' ELSE 'Medicare_Advantage' END
             ELSE CASE c_custkey % 4 WHEN 0 THEN 'Commercial' WHEN 1 THEN 'Medicaid' WHEN 2 THEN 'Self_pay' ELSE 'Medicare' END END AS insurance,
        c_mktsegment AS race,
        CASE WHEN (c_custkey * 7) % 10 < 3 THEN 1 ELSE 0 END AS has_diabetes, CASE WHEN (c_custkey * 11) % 10 < 5 THEN 1 ELSE 0 END AS has_hypertension,
        CASE WHEN (c_custkey * 3) % 13 < 2 THEN 1 ELSE 0 END AS has_heart_disease, CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS has_copd,
        CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS has_ckd, CASE WHEN c_custkey % 14 = 0 THEN 1 ELSE 0 END AS has_cancer_history,
        CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END AS has_depression FROM {customer} c) b
"""

ADMISSIONS = """
SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr,
       CASE o_orderkey % 6 WHEN 0 THEN 'Caucasian' WHEN 1 THEN 'AfricanAmerican' WHEN 2 THEN 'Hispanic' WHEN 3 THEN 'Asian' WHEN 4 THEN 'Other' ELSE '?' END AS race,
       CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       concat('[', CAST((o_custkey % 10) * 10 AS STRING), '-', CAST((o_custkey % 10) * 10 + 10 AS STRING), ')') AS age, '?' AS weight, 'MC' AS payer_code,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 1 + o_orderkey % 8 END AS admission_type_id,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 1 + o_orderkey % 25 END AS discharge_disposition_id, 1 + o_orderkey % 26 AS admission_source_id,
       1 + o_orderkey % 14 AS time_in_hospital, (o_orderkey * 7) % 100 AS num_lab_procedures, o_orderkey % 7 AS num_procedures, 1 + (o_orderkey * 3) % 60 AS num_medications,
       (o_orderkey * 5) % 4 AS number_outpatient, (o_orderkey * 11) % 3 AS number_emergency, (o_orderkey * 13) % 5 AS number_inpatient, 1 + o_orderkey % 9 AS number_diagnoses,
       CASE WHEN o_orderkey % 301 = 0 THEN 'RareSpec' WHEN o_orderkey % 3 = 0 THEN '?' WHEN o_orderkey % 3 = 1 THEN 'Cardiology' ELSE 'Surgery' END AS medical_specialty,
       CASE o_orderkey % 8 WHEN 0 THEN '250.7' WHEN 1 THEN '428' WHEN 2 THEN '491' WHEN 3 THEN 'V57' WHEN 4 THEN 'E909' WHEN 5 THEN '820' WHEN 6 THEN '199' ELSE '?' END AS diag_1,
       CASE o_orderkey % 5 WHEN 0 THEN '276' WHEN 1 THEN '715' WHEN 2 THEN '550' WHEN 3 THEN '788' ELSE '250' END AS diag_2, CAST(140 + o_orderkey % 860 AS STRING) AS diag_3,
       CASE o_orderkey % 4 WHEN 0 THEN '>8' WHEN 1 THEN 'Norm' ELSE 'None' END AS A1Cresult, CASE o_orderkey % 5 WHEN 0 THEN '>200' WHEN 1 THEN 'Norm' ELSE '?' END AS max_glu_serum,
       CASE o_orderkey % 4 WHEN 0 THEN 'Up' WHEN 1 THEN 'Down' WHEN 2 THEN 'Steady' ELSE 'No' END AS insulin, CASE o_orderkey % 3 WHEN 0 THEN 'Steady' WHEN 1 THEN 'Up' ELSE 'No' END AS metformin,
       CASE WHEN o_orderkey % 6 = 0 THEN 'Down' ELSE 'No' END AS glipizide, CASE WHEN o_orderkey % 2 = 0 THEN 'Ch' ELSE 'No' END AS change, CASE WHEN o_orderkey % 4 = 3 THEN 'No' ELSE 'Yes' END AS diabetesMed,
       CASE WHEN (o_orderkey * 17) % 11 = 0 THEN '<30' WHEN o_orderkey % 3 = 0 THEN '>30' ELSE 'NO' END AS readmitted
FROM {orders} o
"""

SCORES = """
SELECT c_custkey AS patient_id, CAST((c_custkey * 7919) % 10000 AS DOUBLE) / 10000 AS probability,
       CASE WHEN ((c_custkey * 7919) % 10000) + ((c_custkey * 104729) % 9000) > 13000 THEN 1 ELSE 0 END AS y_true,
       c_mktsegment AS subgroup,
       CASE c_custkey % 9 WHEN 0 THEN 'prior inpatient visits: 3; insulin: Down; prior admissions: 3' WHEN 1 THEN 'age: 85; days in hospital: 9'
            WHEN 2 THEN 'medications: 18; active medications: 3' WHEN 3 THEN 'HbA1c: >8; glucose serum: >200; primary diagnosis: Diabetes'
            WHEN 4 THEN 'procedures: 4' WHEN 5 THEN 'discharge disposition: Home Health; diagnoses on record: 9'
            WHEN 6 THEN 'prior ER visits: 2; medications changed: 2' WHEN 7 THEN 'on diabetes medication: 1; specialty: Cardiology'
            ELSE 'no elevated risk factors' END AS top_3_risk_factors
FROM {customer} c
"""

CONTACT_LOG = """
SELECT CAST(c_custkey AS STRING) AS patient_id,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(DATE '2024-01-01' + CAST((c_custkey * 7) % 120 AS INT) AS STRING)
            WHEN c_custkey % 3 = 1 THEN 'not yet' ELSE NULL END AS last_contacted
FROM {customer} c
"""

VIEWS = {
    "patients": PATIENTS,
    "conditions": CONDITIONS,
    "observations": OBSERVATIONS,
    "encounters": ENCOUNTERS,
    "medications": MEDICATIONS,
    "notes": NOTES,
    "population": POPULATION,
    "admissions": ADMISSIONS,
    "scores": SCORES,
    "contact_log": CONTACT_LOG,
}


def tables_in(text: str) -> set[str]:
    return {name for _, name, _, _ in string.Formatter().parse(text) if name}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_over(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    frames = {name: table(spark, sf_dir, name) for name in tables_in(text)}
    return spark.sql(text, **frames)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sql_over(spark, sf_dir, VIEWS[name])


def duck_cte(name: str) -> str:
    """``fx_<name> AS (...)`` for a DuckDB WITH clause."""
    text = VIEWS[name]
    return f"fx_{name} AS ({text.format(**{t: t for t in tables_in(text)}).strip()})"
