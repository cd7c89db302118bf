"""ICD-9 groups and engineered features."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carepanel.operators import encounter_features as ef

ICD9 = [
    ("250.7", "Diabetes"), ("250", "Diabetes"), ("428", "Circulatory"), ("785", "Circulatory"), ("491", "Respiratory"),
    ("786", "Respiratory"), ("550", "Digestive"), ("820", "Injury"), ("715", "Musculoskeletal"), ("600", "Genitourinary"),
    ("788", "Genitourinary"), ("199", "Neoplasm"), ("V57", "Other"), ("E909", "Injury"), ("somegarbage", "Other"), (None, "Missing"),
    # a trailing type letter is no number, and white space is no code
    ("428d", "Other"), ("  ", "Missing"), (" 428 ", "Circulatory"), ("251", "Other"), ("250.99", "Diabetes"),
]

SCHEMA = (
    "patient_nbr long, encounter_id long, readmit_30d int, age_midpoint double, time_in_hospital long, num_lab_procedures long, "
    "num_procedures long, num_medications long, number_outpatient long, number_emergency long, number_inpatient long, "
    "number_diagnoses long, admission_type_id long, admission_source_id long, discharge_disposition_id long, diag_1 string, "
    "diag_2 string, diag_3 string, A1Cresult string, max_glu_serum string, change string, diabetesMed string, change_flag int, "
    "diabetes_med_flag int, race string, gender string, medical_specialty string, insulin string, metformin string, glipizide string"
)


@pytest.fixture(scope="module")
def cleaned(spark):
    data = [
        (1, 11, 1, 75.0, 3, 40, 1, 10, 0, 1, 2, 9, 1, 7, 1, "428", "276", "414", ">8", None, "Ch", "Yes", 1, 1, "Caucasian", "Male", "Cardiology", "Up", "Steady", "No"),
        (2, 22, 0, 65.0, 4, 50, 2, 12, 1, 0, 0, 7, 3, 1, 6, "250.7", "428", "?", None, ">200", "No", "Yes", 0, 1, None, "Female", None, "No", "No", "Down"),
        (3, 33, 0, 55.0, 5, 60, 3, 14, 2, 3, 1, 5, 6, 17, 2, "V57", "250", "820", "Norm", "Norm", "Ch", "No", 1, 0, "AfricanAmerican", "Male", "Surgery", "Steady", "Up", "No"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_icd9_groups(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(ICD9)], "i int, code string")
    got = {r.i: r.g for r in df.select("i", ef.icd9_group(F.col("code")).alias("g")).collect()}
    assert [got[i] for i in range(len(ICD9))] == [g for _, g in ICD9]


def test_utilization(cleaned):
    out = rows(ef.add_utilization(cleaned), "encounter_id", "num_prior_admissions", "num_chronic_conditions")
    assert out == [(11, 3, 9), (22, 1, 7), (33, 6, 5)]


def test_medication_churn(cleaned):
    assert rows(ef.add_medication_churn(cleaned), "encounter_id", "num_meds_changed", "num_meds_on") == [(11, 1, 2), (22, 1, 1), (33, 1, 2)]


def test_missing_lab_is_a_level(cleaned):
    assert rows(ef.add_lab_levels(cleaned), "encounter_id", "a1c_result", "max_glu_serum_grp") == [
        (11, ">8", "None"), (22, "None", ">200"), (33, "Norm", "Norm"),
    ]


def test_feature_contract(cleaned):
    out = ef.build_features(cleaned)
    assert out.columns == ["patient_nbr", "encounter_id", "readmit_30d", *ef.ALL_FEATURES]
    assert len(ef.ALL_FEATURES) == 26 and out.count() == 3
    assert rows(out, "encounter_id", "medical_specialty_grp", "race")[1] == (22, "Unknown", "Unknown")
    with pytest.raises(ValueError, match="admission_type_grp"):
        ef.build_features(cleaned.drop("admission_type_id"))


def test_diagnosis_and_admin_groups(cleaned):
    assert rows(ef.add_diagnosis_groups(cleaned), "encounter_id", "diag_1_group")[:2] == [(11, "Circulatory"), (22, "Diabetes")]
    assert rows(ef.add_diagnosis_groups(cleaned.drop("diag_2")), "diag_2_group") == [("Missing",)] * 3
    out = rows(ef.add_admin_groups(cleaned), "encounter_id", "admission_type_grp", "admission_source_grp", "discharge_disposition_grp")
    assert out == [
        (11, "Emergency", "Emergency Room", "Home"),
        (22, "Elective", "Physician Referral", "Home Health"),
        (33, "Unknown", "Other", "Transferred Facility"),
    ]


def test_rare_levels_collapse_and_a_rare_null_is_other(spark):
    data = [("A",)] * 150 + [("B",)] * 60 + [("C",)] + [(None,)]
    df = spark.createDataFrame(data, "medical_specialty string")
    out = ef.collapse_rare(df, "medical_specialty").groupBy("medical_specialty").count()
    assert rows(out) == [("A", 150), ("B", 60), ("Other", 2)]
    frequent_null = spark.createDataFrame([("A",)] * 5 + [(None,)] * 5, "medical_specialty string")
    assert ef.collapse_rare(frequent_null, "medical_specialty").where("medical_specialty IS NULL").count() == 5
