"""Nested clinical resources to flat tables keyed by ``patient_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import plain_number
from carepanel.sources.resources import FEED, only_kind

PER_PATIENT_LIMIT = 50
MEDICATION_LIMIT = 100


def first_of(array: Column) -> Column:
    return F.get(array, F.lit(0))


def or_empty(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))


def subject_id() -> Column:
    """Patient id of a ``Patient/<id>`` reference, null for any other reference."""
    ref = F.col("subject.reference")
    pid = F.nullif(F.substring(ref, F.lit(len("Patient/") + 1), F.length(ref)), F.lit(""))
    return F.when(ref.startswith("Patient/"), pid)


def flatten_conditions(conditions: DataFrame) -> DataFrame:
    """One row per coding; a condition without codings gives none."""
    status = first_of(F.col("clinicalStatus.coding"))["code"]
    return (
        only_kind(conditions, "Condition")
        .select(
            subject_id().alias("patient_id"),
            or_empty("id").alias("condition_id"),
            F.coalesce(status, F.lit("unknown")).alias("clinical_status"),
            or_empty("onsetDateTime").alias("onset_date"),
            F.explode("code.coding").alias("coding"),
        )
        .select(
            "patient_id",
            "condition_id",
            or_empty("coding.code").alias("code"),
            or_empty("coding.display").alias("display"),
            or_empty("coding.system").alias("system"),
            "clinical_status",
            "onset_date",
        )
    )


def loinc_coding() -> Column:
    """First coding whose system mentions LOINC, in any letter case."""
    is_loinc = lambda c: F.lower(c["system"]).contains("loinc")
    return first_of(F.filter(F.col("code.coding"), is_loinc))


def observation_value() -> Column:
    """Value text by which of the value fields is *present*; a present empty quantity stays null."""
    return (
        F.when(F.col("valueQuantity").isNotNull(), F.col("valueQuantity.value"))
        .when(
            F.col("valueCodeableConcept").isNotNull(),
            or_empty(first_of(F.col("valueCodeableConcept.coding"))["display"]),
        )
        .when(F.col("valueString").isNotNull(), F.col("valueString"))
    )


def flatten_observations(observations: DataFrame) -> DataFrame:
    coding = loinc_coding()
    interpretation = first_of(first_of(F.col("interpretation"))["coding"])["code"]
    return with_numeric_value(
        only_kind(observations, "Observation").select(
            subject_id().alias("patient_id"),
            or_empty("id").alias("observation_id"),
            or_empty(coding["code"]).alias("loinc_code"),
            or_empty(coding["display"]).alias("display"),
            observation_value().alias("value_text"),
            or_empty("valueQuantity.unit").alias("unit"),
            or_empty(interpretation).alias("interpretation"),
            or_empty("effectiveDateTime").alias("effective_date"),
            *_feed_order(observations),
        )
    )


def _feed_order(resources: DataFrame) -> list[Column]:
    """The place in the export as ``seq``, where the scan has kept it."""
    return [F.col(FEED).alias("seq")] if FEED in resources.columns else []


def with_numeric_value(observations: DataFrame) -> DataFrame:
    """Text that reads as a number also gets a numeric column; other text stays text only."""
    return observations.withColumn("value_num", plain_number("value_text"))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days between two ISO texts, rounded down; null unless both are full dates.

    Mixing one text with a UTC offset and one without is undefined and gives null.
    """
    full_date = r"^\d{4}-\d{2}-\d{2}([T ]|$)"
    with_zone = r"[T ].*(Z|[+-]\d{2}:?\d{2})$"

    def micros(text: Column) -> Column:
        at_midnight = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00"))).otherwise(text)
        in_utc = F.when(text.rlike(with_zone), text).otherwise(F.concat(at_midnight, F.lit("Z")))
        return F.unix_micros(F.try_to_timestamp(in_utc))

    comparable = start.rlike(full_date) & end.rlike(full_date) & (start.rlike(with_zone) == end.rlike(with_zone))
    days = F.floor((micros(end) - micros(start)) / F.lit(86_400_000_000))
    return F.when(comparable, days.cast("int"))


def flatten_encounters(encounters: DataFrame) -> DataFrame:
    return only_kind(encounters, "Encounter").select(
        subject_id().alias("patient_id"),
        or_empty("id").alias("encounter_id"),
        or_empty("status").alias("status"),
        F.coalesce(F.col("class.code"), F.lit("unknown")).alias("class_code"),
        or_empty("period.start").alias("start_date"),
        or_empty("period.end").alias("end_date"),
        elapsed_days(F.col("period.start"), F.col("period.end")).alias("length_of_stay_days"),
    )


def flatten_medication_requests(requests: DataFrame) -> DataFrame:
    return requests.select(
        subject_id().alias("patient_id"),
        or_empty("id").alias("medication_id"),
        or_empty("status").alias("status"),
    )


def age_in_years(birth_date: Column, as_of: Column) -> Column:
    """Completed years; a 29 February birthday counts on 28 February of common years."""
    return F.floor(F.months_between(as_of, birth_date) / 12).cast("int")


def flatten_patients(patients: DataFrame, as_of: str) -> DataFrame:
    """Identity, first address and first phone of each patient. Holds PHI until de-identified."""
    name, address = first_of(F.col("name")), first_of(F.col("address"))
    phones = F.filter(F.col("telecom"), lambda t: t["system"] == "phone")
    birth = F.try_to_date(F.col("birthDate"), "yyyy-M-d")
    return only_kind(patients, "Patient").select(
        or_empty("id").alias("patient_id"),
        or_empty(name["family"]).alias("family_name"),
        or_empty(first_of(name["given"])).alias("given_name"),
        or_empty("birthDate").alias("date_of_birth"),
        age_in_years(birth, F.lit(as_of).cast("date")).alias("age"),
        F.coalesce(F.col("gender"), F.lit("unknown")).alias("gender"),
        or_empty(address["state"]).alias("state"),
        or_empty(address["postalCode"]).alias("zip_code"),
        or_empty(first_of(phones)["value"]).alias("phone"),
    )


def condition_subjects(conditions: DataFrame) -> DataFrame:
    """Patient of every condition, coded or not: what cohort discovery looks at."""
    return only_kind(conditions, "Condition").select(
        subject_id().alias("patient_id"), or_empty("id").alias("condition_id"), *_feed_order(conditions)
    )


def cohort_ids(conditions: DataFrame, order_by: str, limit: int | None = None) -> DataFrame:
    """Distinct patients with a condition, in order of first appearance, optionally the first few."""
    ids = (
        conditions.where(F.col("patient_id").isNotNull())
        .groupBy("patient_id")
        .agg(F.min(order_by).alias("first_seen"))
    )
    if limit is not None:
        ids = ids.orderBy("first_seen", "patient_id").limit(limit)
    return ids.select("patient_id")


def cohort_patients(patients: DataFrame, conditions: DataFrame, order_by: str, limit: int | None = None) -> DataFrame:
    return patients.join(cohort_ids(conditions, order_by, limit), "patient_id", "left_semi")


def latest_per_patient(rows: DataFrame, date_col: str, tie_col: str, limit: int | None = PER_PATIENT_LIMIT) -> DataFrame:
    """Newest ``limit`` rows per patient; None takes all.

    Spark turns ``row_number() <= k`` into a group limit that runs before the shuffle, so a patient
    with a third of all rows still sends at most k rows per input partition.
    """
    if limit is None:
        return rows
    newest = Window.partitionBy("patient_id").orderBy(F.col(date_col).desc_nulls_last(), F.col(tie_col).asc())
    return rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= limit).drop("_rank")


def latest_observations(
    observations: DataFrame, tie_col: str = "seq", loinc_codes: list[str] | None = None, limit: int | None = PER_PATIENT_LIMIT
) -> DataFrame:
    if loinc_codes:
        observations = observations.where(F.col("loinc_code").isin(loinc_codes))
    return latest_per_patient(observations, "effective_date", tie_col, limit)


def latest_encounters(encounters: DataFrame, tie_col: str = "encounter_id", limit: int | None = PER_PATIENT_LIMIT) -> DataFrame:
    return latest_per_patient(encounters, "start_date", tie_col, limit)


def active_medication_counts(medications: DataFrame, limit: int | None = MEDICATION_LIMIT) -> DataFrame:
    count = F.count("*") if limit is None else F.least(F.count("*"), F.lit(limit))
    return (
        medications.where(F.col("status") == "active")
        .groupBy("patient_id")
        .agg(count.cast("int").alias("num_active_medications"))
    )
