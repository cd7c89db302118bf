"""Cleaning steps on a five-row table with one repeated patient, one expired discharge and two outliers."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carepanel.operators import cleaning
from carepanel.sources.encounters import coerce_numbers, load_encounters, read_encounter_csv

COLUMNS = (
    "encounter_id long, patient_nbr long, age string, weight string, payer_code string, discharge_disposition_id long, "
    "number_inpatient long, number_emergency long, number_outpatient long, time_in_hospital long, num_medications long, "
    "change string, diabetesMed string, readmitted string"
)


@pytest.fixture(scope="module")
def raw(spark):
    data = [
        (1, 10, "[70-80)", "?", "MC", 1, 0, 0, 0, 2, 5, "Ch", "Yes", "<30"),
        (2, 10, "[60-70)", "?", "?", 1, 1, 0, 0, 3, 6, "No", "No", ">30"),
        (3, 20, "[80-90)", "?", "MC", 11, 2, 0, 0, 4, 7, "Ch", "Yes", "NO"),
        (4, 30, "[40-50)", "?", "?", 1, 3, 0, 0, 5, 8, "No", "No", "<30"),
        (5, 40, "[50-60)", "?", "MC", 1, 100, 0, 0, 500, 9, "Ch", "Yes", "NO"),
    ]
    return spark.createDataFrame(data, COLUMNS)


def test_missing_tokens_become_null(raw):
    out = cleaning.missing_to_null(raw)
    assert out.where("payer_code IS NULL").count() == 2
    assert out.where("weight IS NOT NULL").count() == 0


def test_sparse_columns_are_dropped(raw):
    assert not set(cleaning.SPARSE_COLUMNS) & set(cleaning.drop_sparse(raw).columns)


def test_expired_and_hospice_are_excluded_but_unknown_stays(raw):
    out = cleaning.exclude_expired(raw)
    assert sorted(r.encounter_id for r in out.collect()) == [1, 2, 4, 5]
    unknown = raw.withColumn("discharge_disposition_id", F.lit(None).cast("long"))
    assert cleaning.exclude_expired(unknown).count() == 5


def test_first_encounter_per_patient_is_kept(raw):
    assert rows(cleaning.first_encounters(raw), "patient_nbr", "encounter_id") == [(10, 1), (20, 3), (30, 4), (40, 5)]


def test_outliers_are_capped_at_the_interpolated_quantile(raw):
    top = cleaning.cap_outliers(raw).agg(F.max("number_inpatient"), F.max("time_in_hospital")).first()
    assert top[0] == pytest.approx(3 + 0.96 * 97)
    assert top[1] == pytest.approx(5 + 0.96 * 495)


def test_target_is_readmission_within_30_days(raw):
    assert rows(cleaning.add_target(raw), "encounter_id", "readmit_30d") == [(1, 1), (2, 0), (3, 0), (4, 1), (5, 0)]


def test_age_midpoint_and_flags(raw):
    out = rows(cleaning.standardize(raw), "encounter_id", "age_midpoint", "change_flag", "diabetes_med_flag")
    assert out[0] == (1, 75.0, 1, 1) and out[1] == (2, 65.0, 0, 0)


def test_whole_cleaning_and_provenance(raw):
    out = cleaning.clean(raw)
    assert out.count() == out.select("patient_nbr").distinct().count() == 3
    assert cleaning.provenance(raw).first().asDict() == {
        "rows_raw": 5, "rows_after_exclusions": 4, "rows_after_dedup": 3, "rows_final": 3, "positive_rate": 0.6667,
    }


def test_csv_source_is_text_until_coerced(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("encounter_id,patient_nbr,readmitted,num_medications\n1,10,NO,abc\n2,11,<30,\n3,12,?, 7\n")
    names = ["encounter_id", "patient_nbr", "readmitted", "num_medications"]
    text = read_encounter_csv(spark, str(path), names)
    assert {t for _, t in text.dtypes} == {"string"}
    typed = load_encounters(spark, str(path), lambda s, p: read_encounter_csv(s, p, names))
    assert rows(typed, "encounter_id", "num_medications") == [(1, None), (2, None), (3, 7.0)]
    with pytest.raises(ValueError, match="readmitted"):
        load_encounters(spark, str(path), lambda s, p: text.drop("readmitted"))
    assert coerce_numbers(text).schema["patient_nbr"].dataType.simpleString() == "bigint"


def test_first_encounter_under_one_dominant_patient(spark):
    hot = spark.range(4000).selectExpr("id AS encounter_id", "7L AS patient_nbr")
    rest = spark.range(4000, 6000).selectExpr("id AS encounter_id", "id AS patient_nbr")
    out = cleaning.first_encounters(hot.unionByName(rest))
    assert out.count() == 2001 and out.where("patient_nbr = 7").first().encounter_id == 0


def test_csv_read_by_its_own_header(spark, tmp_path):
    from carepanel.sources.encounters import read_csv_by_header

    path = tmp_path / "enc.csv"
    path.write_text('readmitted,extra,patient_nbr,encounter_id\nNO,"two\nlines",7,1\n<30,,8\n>30,x,9,3,too many\n"",y,10,4\n')
    rows, broken = read_csv_by_header(spark, str(path), ["encounter_id", "patient_nbr", "readmitted"])
    assert rows.columns == ["readmitted", "extra", "patient_nbr", "encounter_id"]
    assert sorted(tuple(r) for r in rows.collect()) == [("", "y", "10", "4"), ("NO", "two\nlines", "7", "1")]
    assert sorted(r.record for r in broken.collect()) == ["<30,,8", ">30,x,9,3,too many"]
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv_by_header(spark, str(path), ["encounter_id", "admission_type_id"])
