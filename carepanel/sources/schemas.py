"""Declared schemas. Only fields that some operator uses are read."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_SUBJECT = "subject STRUCT<reference: STRING>"
_CODINGS = "code STRUCT<coding: ARRAY<STRUCT<code: STRING, display: STRING, system: STRING>>>"

# One nested schema per resource type; a missing field is null, a line that is no JSON or does not fit is kept aside.
RESOURCE_DDL = {
    "Patient": (
        "id STRING, resourceType STRING, name ARRAY<STRUCT<family: STRING, given: ARRAY<STRING>>>, "
        "birthDate STRING, gender STRING, address ARRAY<STRUCT<state: STRING, postalCode: STRING>>, "
        "telecom ARRAY<STRUCT<system: STRING, value: STRING>>"
    ),
    "Condition": (
        f"id STRING, resourceType STRING, {_SUBJECT}, {_CODINGS}, "
        "clinicalStatus STRUCT<coding: ARRAY<STRUCT<code: STRING>>>, onsetDateTime STRING"
    ),
    "Observation": (
        f"id STRING, resourceType STRING, {_SUBJECT}, {_CODINGS}, "
        "valueQuantity STRUCT<value: STRING, unit: STRING>, "
        "valueCodeableConcept STRUCT<coding: ARRAY<STRUCT<display: STRING>>>, valueString STRING, "
        "interpretation ARRAY<STRUCT<coding: ARRAY<STRUCT<code: STRING>>>>, effectiveDateTime STRING"
    ),
    "Encounter": (
        f"id STRING, resourceType STRING, {_SUBJECT}, status STRING, class STRUCT<code: STRING>, "
        "period STRUCT<start: STRING, end: STRING>"
    ),
    "MedicationRequest": f"id STRING, resourceType STRING, {_SUBJECT}, status STRING",
}


def resource_schema(kind: str) -> T.StructType:
    schema = T.StructType.fromDDL(RESOURCE_DDL[kind])
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


# The drug columns of the readmission data set.
MEDICATION_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide",
    "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide",
    "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]

# Columns of the raw encounter file that hold numbers.
ENCOUNTER_NUMBERS = [
    "encounter_id", "patient_nbr", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
    "number_diagnoses",
]

ENCOUNTER_IDS = ["encounter_id", "patient_nbr"]
ENCOUNTER_REQUIRED = ["encounter_id", "patient_nbr", "readmitted"]
