"""From clinical resources to a de-identified, scored patient feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carepanel.operators import patient_features as pf
from carepanel.operators import resources as rs
from carepanel.operators import quality, rule_risk
from carepanel.operators.privacy import deidentify
from carepanel.operators.rule_risk import add_rule_risk
from carepanel.sources.resources import read_resources, split_corrupt
from carepanel.sources.sinks import write_tables, write_versioned


def identified_features(
    patients: DataFrame, conditions: DataFrame, observations: DataFrame, encounters: DataFrame, medications: DataFrame,
    per_patient: int | None = rs.PER_PATIENT_LIMIT, medication_limit: int | None = rs.MEDICATION_LIMIT,
) -> DataFrame:
    """All features per patient, still holding identifiers. Inputs are the flat child tables.

    The limits are the page sizes of the service that such records usually come from; None uses every record of a
    bulk export.
    """
    joined = pf.assemble_patients(
        pf.demographic_flags(patients),
        pf.condition_features(conditions),
        pf.lab_flags(pf.latest_lab_values(rs.latest_observations(observations, limit=per_patient))),
        rs.active_medication_counts(medications, medication_limit),
        pf.encounter_features(rs.latest_encounters(encounters, limit=per_patient)),
    )
    return pf.composite_flags(pf.burden_flags(joined))


def patient_feature_table(*tables: DataFrame, salt: str = "", **limits: int | None) -> DataFrame:
    return add_rule_risk(deidentify(identified_features(*tables, **limits), salt))


def run_from_exports(
    spark: SparkSession, paths: dict[str, str], as_of: str, cohort_size: int | None = None, salt: str = ""
) -> DataFrame:
    """The same from five NDJSON exports; ``paths`` maps each resource type to its location.

    Patients without any condition are left out, as the cohort is defined by the condition feed.
    """
    raw = {kind: read_resources(spark, path, kind) for kind, path in paths.items()}
    return features_of(raw, as_of, cohort_size, salt)


def features_of(
    raw: dict[str, DataFrame], as_of: str, cohort_size: int | None = None, salt: str = "", **limits: int | None
) -> DataFrame:
    """The feature table from parsed resources by type; the cohort is in the order of the condition feed."""
    conditions = rs.flatten_conditions(raw["Condition"])
    observations = rs.flatten_observations(raw["Observation"])
    subjects = rs.condition_subjects(raw["Condition"])
    patients = rs.cohort_patients(rs.flatten_patients(raw["Patient"], as_of), subjects, "seq", cohort_size)
    return patient_feature_table(
        patients,
        conditions,
        observations,
        rs.flatten_encounters(raw["Encounter"]),
        rs.flatten_medication_requests(raw["MedicationRequest"]),
        salt=salt,
        **limits,
    )


def run(
    spark: SparkSession, paths: dict[str, str], root: str, as_of: str, cohort_size: int | None = None, salt: str = "", **limits: int | None
) -> str:
    """The whole job under ``root``: intake, quarantine, features, quality report and a versioned snapshot.

    Each resource type is parsed once and stored; features come from the good half, and the records that could not
    be parsed are listed under ``quarantine``. Returns where the snapshot lies.
    """
    good = {}
    for kind, path in paths.items():
        read_resources(spark, path, kind).write.mode("overwrite").parquet(f"{root}/intake/{kind}")
        stored = spark.read.parquet(f"{root}/intake/{kind}")
        good[kind], bad = stored, split_corrupt(stored)[1]
        bad.write.mode("overwrite").text(f"{root}/quarantine/{kind}")
    features_of(good, as_of, cohort_size, salt, **limits).write.mode("overwrite").parquet(f"{root}/features")
    features = spark.read.parquet(f"{root}/features")
    report = {
        "completeness": quality.completeness(features),
        "validity": quality.validity(features),
        "distribution": quality.distribution(features),
        "prevalence": quality.prevalence(features),
        "risk_indicators": quality.risk_indicators(features),
        "tier_counts": rule_risk.tier_counts(features),
    }
    write_tables({f"quality/{name}": table for name, table in report.items()}, root)
    return write_versioned(features, f"{root}/patient_features")
