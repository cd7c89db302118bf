"""Registered queries over clinical resources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.operators import patient_features as pf
from carepanel.operators import privacy, quality, rule_risk
from carepanel.operators import resources as rs
from carepanel.plans import resource_job
from carepanel.sources.fixture_views import sql_over, view
from carepanel.sources import resources as rs_source
from carepanel.sources.resources import parse_resources, split_corrupt
from carepanel.sources.schemas import CORRUPT
from carepanel.sources.scratch import ensure_checkpoint_dir

AS_OF = "2024-04-01"

# Resource documents as JSON text, derived from the given tables, with broken and foreign records.
CONDITION_JSON = """
SELECT CASE WHEN l_orderkey % 97 = 5 THEN '{{"resourceType":"Condition",' ELSE to_json(named_struct(
  'id', concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)),
  'resourceType', CASE WHEN l_orderkey % 50 = 7 THEN 'Patient' ELSE 'Condition' END,
  'subject', named_struct('reference', concat(CASE WHEN l_orderkey % 41 = 3 THEN 'Group/' ELSE 'Patient/' END, CAST(o_custkey AS STRING))),
  'code', named_struct('coding', CASE l_partkey % 3 WHEN 0 THEN array()
     WHEN 1 THEN array(named_struct('code', concat('E', CAST(l_partkey % 90 AS STRING)), 'display', 'first', 'system', 'icd10'))
     ELSE array(named_struct('code', concat('E', CAST(l_partkey % 90 AS STRING)), 'display', 'first', 'system', 'icd10'),
                named_struct('code', '73211009', 'display', CAST(NULL AS STRING), 'system', 'snomed')) END),
  'clinicalStatus', CASE WHEN l_linestatus = 'O' THEN named_struct('coding', array(named_struct('code', 'active'))) END,
  'onsetDateTime', CAST(CAST(l_shipdate AS DATE) AS STRING))) END AS value
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

OBSERVATION_JSON = """
SELECT CASE WHEN event_id % 211 = 5 THEN 'not json' ELSE to_json(named_struct(
  'id', CAST(event_id AS STRING), 'resourceType', 'Observation',
  'subject', named_struct('reference', concat('Patient/', CAST(user_id AS STRING))),
  'code', named_struct('coding', CASE event_id % 4
     WHEN 0 THEN array(named_struct('code', '4548-4', 'display', 'HbA1c', 'system', 'http://loinc.org'))
     WHEN 1 THEN array(named_struct('code', 'S1', 'display', 'local', 'system', 'http://snomed.info/sct'),
                       named_struct('code', '718-7', 'display', 'Hgb', 'system', 'http://LOINC.org'))
     WHEN 2 THEN array(named_struct('code', 'S2', 'display', 'local', 'system', 'http://snomed.info/sct')) ELSE array() END),
  'valueQuantity', CASE WHEN event_id % 5 = 0 THEN named_struct('value', CAST(CAST(event_id % 80 AS DOUBLE) / 8 AS STRING), 'unit', '%')
                        WHEN event_id % 5 = 1 THEN named_struct('value', CAST(NULL AS STRING), 'unit', 'mg') END,
  'valueCodeableConcept', CASE WHEN event_id % 5 = 2 THEN named_struct('coding', array(named_struct('display', 'positive'))) END,
  'valueString', CASE WHEN event_id % 5 IN (1, 3) THEN '12.5' END,
  'interpretation', CASE event_id % 3 WHEN 0 THEN array(named_struct('coding', array(named_struct('code', 'H'))))
                         WHEN 1 THEN array() END,
  'effectiveDateTime', CAST(CAST(ts AS DATE) AS STRING))) END AS value
FROM {events} e
"""

ENCOUNTER_JSON = """
SELECT to_json(named_struct('id', CAST(k AS STRING), 'resourceType', 'Encounter',
  'subject', named_struct('reference', concat('Patient/', CAST(o_custkey AS STRING))),
  'status', CASE WHEN k % 2 = 0 THEN 'finished' END,
  'class', CASE WHEN k % 5 > 0 THEN named_struct('code', 'IMP') END,
  'period', named_struct(
     'start', concat(CAST(d AS STRING), 'T', lpad(CAST(k % 24 AS STRING), 2, '0'), ':00:00',
                     CASE k % 6 WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' WHEN 4 THEN 'Z' ELSE '' END),
     'end', CASE k % 6 WHEN 3 THEN NULL WHEN 5 THEN substring(CAST(d AS STRING), 1, 7)
            ELSE concat(CAST(d + CAST((k * 13) % 15 AS INT) AS STRING), 'T', lpad(CAST((k * 7) % 24 AS STRING), 2, '0'), ':00:00',
                     CASE k % 6 WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' ELSE '' END) END))) AS value
FROM (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS d FROM {orders} o) x
"""

PATIENT_JSON = """
SELECT to_json(named_struct('id', CAST(c_custkey AS STRING), 'resourceType', 'Patient',
  'name', CASE WHEN c_custkey % 13 > 0 THEN array(named_struct('family', c_name, 'given', CASE WHEN c_custkey % 3 = 0 THEN array() ELSE array('Pat', 'Q') END)) END,
  'birthDate', CASE c_custkey % 9 WHEN 0 THEN '1950' WHEN 1 THEN '2001-02-30' WHEN 2 THEN '1964-02-29' WHEN 3 THEN NULL
       ELSE CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 31000 AS INT) AS STRING) END,
  'gender', CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END,
  'address', CASE WHEN c_custkey % 7 > 0 THEN array(named_struct('state', n_name, 'postalCode', CAST(10000 + c_custkey AS STRING))) ELSE array() END,
  'telecom', CASE WHEN c_custkey % 5 = 0 THEN array(named_struct('system', 'email', 'value', 'a@b.c'))
       ELSE array(named_struct('system', 'email', 'value', 'a@b.c'), named_struct('system', 'phone', 'value', '555-0100')) END)) AS value
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""


def nullable_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Integer columns holding nulls, as doubles: every client then shows them the same way."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


NULLABLE_LAB_FLAGS = [
    "hba1c_abnormal", "hba1c_poor_control", "creatinine_abnormal", "sodium_low", "anemia_flag",
    "hypertensive_urgency", "obese",
]


def _json(spark: SparkSession, d: str, text: str, kind: str) -> DataFrame:
    return parse_resources(sql_over(spark, d, text), kind)


def _patients(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "patients")
    return p.withColumn("age", rs.age_in_years(F.col("birth_date"), F.lit(AS_OF).cast("date"))).drop("birth_date")


def _features(spark: SparkSession, d: str, **limits: int | None) -> DataFrame:
    return resource_job.patient_feature_table(
        _patients(spark, d),
        view(spark, d, "conditions"),
        rs.with_numeric_value(view(spark, d, "observations")),
        view(spark, d, "encounters"),
        view(spark, d, "medications"),
        **limits,
    )


def patient_features(spark, d, **limits):
    return nullable_numbers(
        _features(spark, d, **limits), *NULLABLE_LAB_FLAGS, "long_stay_history", "uncontrolled_diabetes", "heart_failure_with_anemia"
    )


def scan_quarantine(spark, d):
    good, bad = split_corrupt(_json(spark, d, CONDITION_JSON, "Condition"))
    kept = good.groupBy(F.coalesce("resourceType", F.lit("none")).alias("outcome")).agg(F.count("*").alias("records"))
    return kept.unionByName(bad.groupBy(F.lit("quarantined").alias("outcome")).agg(F.count("*").alias("records")))


def failed_records(spark, d):
    """A25: every condition record the intake cannot use, counted by reason, field, type and whether it names a patient."""
    failed = rs_source.failed_records(_json(spark, d, CONDITION_JSON, "Condition"), "Condition")
    return failed.groupBy("reason", "path", "resource_type", F.col("patient").isNotNull().alias("names_patient")).agg(
        F.count(F.lit(1)).alias("records")
    )


def failed_patients(spark, d):
    """A25: the patients with a failed record, and their good condition records set aside with them.

    The documents are made and parsed once; what the steps read of them is stored for the four passes that follow."""
    parsed = _json(spark, d, CONDITION_JSON, "Condition").select(CORRUPT, "resourceType", "subject")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/intake-{uuid.uuid4().hex}"
    parsed.write.parquet(path)
    resources = spark.read.schema(parsed.schema).parquet(path)
    failed = rs_source.failed_records(resources, "Condition")
    good = rs_source.only_kind(resources, "Condition")
    subject = F.col("subject.reference")
    _, aside = rs_source.set_aside(good, failed, F.when(subject.startswith("Patient/"), F.substring_index(subject, "/", -1)))
    patients = failed.where(F.col("patient").isNotNull()).agg(F.countDistinct("patient").alias("failed_patients"))
    return patients.select("failed_patients", F.lit(aside.count()).cast("long").alias("records_set_aside"))


def cohort(spark, d):
    conditions = view(spark, d, "conditions")
    return rs.cohort_patients(_patients(spark, d), conditions, "condition_id").select("patient_id", "state")


def cohort_first(spark, d):
    return rs.cohort_ids(view(spark, d, "conditions"), "condition_id", 20)


def condition_codings(spark, d):
    return rs.flatten_conditions(_json(spark, d, CONDITION_JSON, "Condition"))


def observation_values(spark, d):
    return rs.flatten_observations(_json(spark, d, OBSERVATION_JSON, "Observation"))


def latest_observations(spark, d):
    obs = rs.latest_observations(rs.with_numeric_value(view(spark, d, "observations")))
    return obs.select("patient_id", "seq", "loinc_code", "effective_date")


def latest_observations_filtered(spark, d):
    codes = [pf.LOINC_CODES["hba1c"], pf.LOINC_CODES["bmi"]]
    obs = rs.latest_observations(view(spark, d, "observations"), loinc_codes=codes, limit=5)
    return obs.select("patient_id", "seq", "loinc_code")


def encounter_stays(spark, d):
    return nullable_numbers(
        rs.flatten_encounters(_json(spark, d, ENCOUNTER_JSON, "Encounter")), "length_of_stay_days"
    )


def latest_encounters(spark, d):
    enc = rs.latest_encounters(view(spark, d, "encounters"), limit=10)
    return enc.select("patient_id", "encounter_id")


def medication_counts(spark, d):
    return rs.active_medication_counts(view(spark, d, "medications"))


def patient_identities(spark, d):
    return nullable_numbers(rs.flatten_patients(_json(spark, d, PATIENT_JSON, "Patient"), AS_OF), "age")


def condition_burden(spark, d):
    return pf.condition_features(view(spark, d, "conditions"))


def latest_labs(spark, d):
    obs = rs.latest_observations(rs.with_numeric_value(view(spark, d, "observations")))
    return nullable_numbers(pf.lab_flags(pf.latest_lab_values(obs)), *NULLABLE_LAB_FLAGS)


def encounter_use(spark, d):
    use = pf.encounter_features(rs.latest_encounters(view(spark, d, "encounters")))
    return nullable_numbers(use, "long_stay_history")


def pseudonyms(spark, d):
    return _patients(spark, d).select("patient_id", privacy.pseudonym("patient_id").alias("patient_token"))


def sample_projection(spark, d):
    return rule_risk.sample_rows(_features(spark, d))


def tier_distribution(spark, d):
    return rule_risk.tier_counts(_features(spark, d))


def top_three(spark, d):
    return rule_risk.highest_risk(_features(spark, d))


def demographic_flags(spark, d):
    return pf.demographic_flags(_patients(spark, d)).select(
        "patient_id", "age", "gender_female", "gender_male", "age_over_65", "age_over_80"
    )


def dq_distribution(spark, d):
    return quality.distribution(_features(spark, d))


QUERIES = {
    "a01_a25_scan_and_quarantine": scan_quarantine,
    "a02_cohort_semi_join": cohort,
    "a25_failed_records": failed_records,
    "a25_failed_patients": failed_patients,
    "a02_cohort_first_seen": cohort_first,
    "a03_condition_codings": condition_codings,
    "a04_a06_a15_observation_values": observation_values,
    "a07_latest_observations": latest_observations,
    "a07_latest_observations_by_code": latest_observations_filtered,
    "a08_length_of_stay": encounter_stays,
    "a09_latest_encounters": latest_encounters,
    "a10_active_medications": medication_counts,
    "a11_a12_patient_flatten_age": patient_identities,
    "a13_a17_condition_burden": condition_burden,
    "a14_a18_latest_lab_flags": latest_labs,
    "a16_demographic_flags": demographic_flags,
    "a20_encounter_use": encounter_use,
    "a19_a21_a24_a31_a32_patient_features": patient_features,
    "a22_patient_features_of_all_records": lambda s, d: patient_features(s, d, per_patient=None, medication_limit=None),
    "a23_pseudonyms": pseudonyms,
    "a26_completeness": lambda s, d: quality.completeness(_features(s, d)),
    "a27_validity": lambda s, d: quality.validity(_features(s, d)),
    "a28_distribution": dq_distribution,
    "a29_prevalence": lambda s, d: quality.prevalence(_features(s, d)),
    "a30_risk_indicators": lambda s, d: quality.risk_indicators(_features(s, d)),
    "a33_tier_counts": tier_distribution,
    "a33_top_three": top_three,
    "a35_sample_projection": sample_projection,
}
