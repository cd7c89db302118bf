"""Nested resources: NDJSON scan, quarantine, and edge cases of the flattening."""

import json

from conftest import rows
from pyspark.sql import functions as F

from carepanel.operators import patient_features as pf
from carepanel.operators import privacy
from carepanel.operators import resources as rs
from carepanel.operators.rule_risk import TIER_EDGES, TIER_LABELS
from carepanel.functions.numeric import right_closed_band
from carepanel.plans import resource_job
from carepanel.sources import sinks
from carepanel.sources.resources import read_resources, split_corrupt

LOINC = "http://loinc.org"


def export(tmp_path, name, records):
    path = tmp_path / f"{name}.ndjson"
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return str(path)


def condition(i, codes, patient="Patient/p1", **more):
    return {
        "id": f"c{i}", "resourceType": "Condition", "subject": {"reference": patient},
        "code": {"coding": [{"code": c, "system": "icd"} for c in codes]}, **more,
    }


def observation(i, value, date, code="4548-4", system=LOINC, interpretation=None, patient="p1"):
    out = {
        "id": f"o{i}", "resourceType": "Observation", "subject": {"reference": f"Patient/{patient}"},
        "code": {"coding": [{"code": "x", "system": "local"}, {"code": code, "system": system}]},
        "effectiveDateTime": date, **value,
    }
    if interpretation is not None:
        out["interpretation"] = [{"coding": [{"code": interpretation}]}]
    return out


def test_scan_keeps_broken_records_aside(spark, tmp_path):
    path = export(tmp_path, "c", [condition(1, ["E11"]), '{"resourceType": "Cond', {"resourceType": "Patient", "id": "p"}])
    good, bad = split_corrupt(read_resources(spark, path, "Condition"))
    assert good.count() == 2 and rows(bad) == [('{"resourceType": "Cond',)]


def test_a_quarantined_line_is_nowhere_else(spark, tmp_path):
    wrong = dict(condition(2, ["I10"], "Patient/p2"), code="text")
    scan = read_resources(spark, export(tmp_path, "c", [condition(1, ["E11"]), wrong, condition(3, [], "Patient/p3")]), "Condition")
    assert [r.patient_id for r in rs.condition_subjects(scan).orderBy("seq").collect()] == ["p1", "p3"]
    assert rows(rs.flatten_conditions(scan), "patient_id") == [("p1",)]
    assert split_corrupt(scan)[1].count() == 1


def test_numbers_are_plain_decimals(spark):
    texts = ["5d", "7.1F", "0x1p3", "NaN", "Infinity", " 7 ", "1e400", "-.5E1", "12.", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "value_text string")
    got = {r.value_text: r.value_num for r in rs.with_numeric_value(df).collect()}
    assert {t: v for t, v in got.items() if v is not None} == {" 7 ": 7.0, "-.5E1": -5.0, "12.": 12.0}


def test_conditions_one_row_per_coding(spark, tmp_path):
    records = [
        condition(1, []),
        condition(2, ["E11.9", "44054006"], clinicalStatus={"coding": [{"code": "active"}]}),
        condition(3, ["I10"], clinicalStatus={"coding": []}, patient="Group/9"),
        {"resourceType": "Patient", "id": "p1"},
    ]
    flat = rs.flatten_conditions(read_resources(spark, export(tmp_path, "c", records), "Condition"))
    assert rows(flat, "patient_id", "condition_id", "code", "clinical_status") == [
        ("p1", "c2", "44054006", "active"), ("p1", "c2", "E11.9", "active"), (None, "c3", "I10", "unknown"),
    ]


def test_observation_value_is_chosen_by_presence(spark, tmp_path):
    records = [
        observation(1, {"valueQuantity": {"value": 7.5, "unit": "%"}}, "2024-01-01", interpretation="H"),
        observation(2, {"valueQuantity": {"unit": "%"}, "valueString": "9"}, "2024-01-02"),
        observation(3, {"valueCodeableConcept": {"coding": [{"display": "positive"}]}}, "2024-01-03", system="urn:LOINC:x"),
        observation(4, {"valueString": "6.1"}, "2024-01-04", system="other"),
        observation(5, {}, "2024-01-05"),
    ]
    flat = rs.flatten_observations(read_resources(spark, export(tmp_path, "o", records), "Observation"))
    assert rows(flat, "observation_id", "loinc_code", "value_text", "value_num", "unit", "interpretation") == [
        ("o1", "4548-4", "7.5", 7.5, "%", "H"),
        ("o2", "4548-4", None, None, "%", ""),
        ("o3", "4548-4", "positive", None, "", ""),
        ("o4", "", "6.1", 6.1, "", ""),
        ("o5", "4548-4", None, None, "", ""),
    ]


def test_length_of_stay(spark):
    cases = [
        ("2024-01-01T23:00:00Z", "2024-01-02T01:00:00Z", 0),
        ("2024-01-01T00:00:00+02:00", "2024-01-03T00:00:00+02:00", 2),
        ("2024-01-01", "2024-01-09", 8),
        ("2024-01-01T10:00:00", "2023-12-31T12:00:00", -1),
        ("2024-01-01T10:00:00Z", "2024-01-04T10:00:00", None),
        ("2024-01", "2024-02-01", None),
        ("2024-01-01", None, None),
        ("2024-13-01", "2024-13-05", None),
        ("2024-01-01T00:00:00.500Z", "2024-01-02T00:00:00.250Z", 0),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r.los for r in df.select("i", rs.elapsed_days(F.col("a"), F.col("b")).alias("los")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_age_on_leap_birthdays(spark):
    cases = [("1964-02-29", "2023-02-28", 59), ("1964-02-29", "2023-02-27", 58), ("2000-05-10", "2024-05-09", 23), ("2000-05-10", "2024-05-10", 24)]
    df = spark.createDataFrame([(i, b, d) for i, (b, d, _) in enumerate(cases)], "i int, b string, d string")
    got = {r.i: r.age for r in df.select("i", rs.age_in_years(F.to_date("b"), F.to_date("d")).alias("age")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_latest_lab_ties_go_to_the_earliest_row_of_the_feed(spark):
    data = [("p", 1, "4548-4", "8.4", "H", "2024-02-01"), ("p", 2, "4548-4", "7.0", "N", "2024-02-01"), ("p", 3, "4548-4", None, "H", "2024-03-01"),
            ("p", 4, "2951-2", "130", "", "2024-01-01"), ("p", 5, "39156-5", "high", "H", "2024-01-01")]
    obs = rs.with_numeric_value(spark.createDataFrame(data, "patient_id string, seq long, loinc_code string, value_text string, interpretation string, effective_date string"))
    r = pf.lab_flags(pf.latest_lab_values(rs.latest_observations(obs))).first()
    assert (r.hba1c_value, r.hba1c_abnormal, r.hba1c_poor_control) == (8.4, 1, 1)
    assert (r.sodium_value, r.sodium_low) == (130.0, None)
    assert (r.bmi, r.obese, r.systolic_bp) == (None, None, None)


def test_top_fifty_under_one_dominant_patient(spark):
    hot = spark.range(3000).selectExpr("'hot' AS patient_id", "id AS seq", "cast(date_add(date'2000-01-01', cast(id as int)) as string) AS effective_date")
    rest = spark.range(60).selectExpr("concat('p', id % 20) AS patient_id", "id AS seq", "'2024-01-01' AS effective_date")
    out = rs.latest_per_patient(hot.unionByName(rest), "effective_date", "seq").groupBy("patient_id").agg(F.count("*").alias("n"), F.min("seq").alias("lo"))
    by = {r.patient_id: (r.n, r.lo) for r in out.collect()}
    assert by["hot"] == (50, 2950) and by["p3"] == (3, 3)


def test_tier_edges(spark):
    df = spark.createDataFrame([(s,) for s in (0, 30, 31, 60, 61, 100)], "s int")
    got = rows(df.select("s", right_closed_band("s", TIER_EDGES, TIER_LABELS, include_lowest=True).alias("t")))
    assert [t for _, t in sorted(got)] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_run_from_exports(spark, tmp_path):
    patients = [
        {"id": "p1", "resourceType": "Patient", "birthDate": "1940-01-01", "gender": "female", "name": [{"family": "F", "given": ["G"]}],
         "address": [{"state": "MA", "postalCode": "02139"}], "telecom": [{"system": "email", "value": "e"}, {"system": "phone", "value": "5"}]},
        {"id": "p2", "resourceType": "Patient"},
        {"id": "p3", "resourceType": "Patient", "gender": "male"},
        {"id": "p4", "resourceType": "Patient", "address": [{"state": "NY"}]},
    ]
    encounters = [
        {"id": f"e{i}", "resourceType": "Encounter", "subject": {"reference": "Patient/p1"}, "class": {"code": "imp"},
         "period": {"start": "2024-01-01", "end": f"2024-01-{2 + 4 * i:02d}"}} for i in range(3)
    ]
    meds = [{"id": f"m{i}", "resourceType": "MedicationRequest", "subject": {"reference": "Patient/p1"}, "status": "active"} for i in range(6)]
    paths = {
        "Patient": export(tmp_path, "p", patients),
        "Condition": export(tmp_path, "c", [condition(1, ["E11"], clinicalStatus={"coding": [{"code": "active"}]}), condition(2, ["I50.1"], "Patient/p2"), condition(3, [], "Patient/p4"), "broken"]),
        "Observation": export(tmp_path, "o", [observation(1, {"valueQuantity": {"value": 9.2}}, "2024-01-01", interpretation="H")]),
        "Encounter": export(tmp_path, "e", encounters),
        "MedicationRequest": export(tmp_path, "m", meds),
    }
    snapshot = resource_job.run(spark, paths, str(tmp_path / "job"), "2024-04-01", per_patient=None, medication_limit=None)
    stored = spark.read.parquet(str(tmp_path / "job" / "features"))
    assert snapshot.endswith("v001") and stored.count() == 3
    assert rows(spark.read.text(str(tmp_path / "job" / "quarantine" / "Condition"))) == [("broken",)]
    assert sinks.read_published(spark, str(tmp_path / "job"), "quality/validity").count() == 3
    first = resource_job.run_from_exports(spark, paths, "2024-04-01", cohort_size=1)
    assert [r.state for r in first.collect()] == ["MA"]
    out = resource_job.run_from_exports(spark, paths, "2024-04-01")
    assert out.columns == [*privacy.SAFE_COLUMNS, "risk_score", "risk_tier"] and len(privacy.SAFE_COLUMNS) == 44
    assert not privacy.PHI_COLUMNS & set(out.columns)
    by_state = {r.state: r for r in out.collect()}
    p1, p2 = by_state["MA"], by_state[""]
    # p3 has no condition at all and is left out; p4 has one without a code and stays
    assert set(by_state) == {"MA", "", "NY"} and by_state["NY"].num_total_conditions == 0
    assert (p1.num_inpatient_encounters, p1.avg_length_of_stay, p1.long_stay_history, p1.polypharmacy) == (3, 5.0, 1, 1)
    assert p1.uncontrolled_diabetes == 1 and p1.risk_score == 30 + 12 + 8 + 8 + 10 + 5 and p1.risk_tier == "HIGH"
    assert (p2.has_heart_failure, p2.num_active_medications, p2.hba1c_value, p2.risk_score) == (1, 0, None, 15)


def test_failed_records_tell_why_and_take_their_patient_along(spark):
    from carepanel.sources.resources import failed_records, only_kind, parse_resources, set_aside

    texts = [
        '{"resourceType":"Condition","id":"1","subject":{"reference":"Patient/p1"}}',
        '{"resourceType":"Condition","id":"2","subject":{"reference":"Patient/p2"}}',
        '{"resourceType":"Condition","id":"3","subject":5}',
        '{"resourceType":"Condition","id":"4","subject":{"reference":"Patient/p2"},"code":',
        '{"resourceType":"Patient","id":"p9","subject":{"reference":"Patient/p1"}}',
        "not json at all",
    ]
    resources = parse_resources(spark.createDataFrame([(t,) for t in texts], "value string"), "Condition")
    failed = failed_records(resources, "Condition")
    got = sorted(((r.reason, r.path, r.resource_type, r.patient) for r in failed.collect()), key=repr)
    assert got == sorted(
        [("syntax", None, "Condition", "p2"), ("syntax", None, None, None), ("wrong resource", None, "Patient", "p1"), ("wrong type", "subject", "Condition", None)],
        key=repr,
    )
    subject = F.col("subject.reference")
    kept, aside = set_aside(only_kind(resources, "Condition"), failed, F.when(subject.startswith("Patient/"), F.substring_index(subject, "/", -1)))
    assert [r.id for r in kept.collect()] == [] and sorted(r.id for r in aside.collect()) == ["1", "2"]


def test_feed_numbers_follow_file_names_and_lines_whatever_the_split(spark, tmp_path):
    from carepanel.sources.resources import numbered_lines

    folder = tmp_path / "feed"
    folder.mkdir()
    for name, first in (("b.ndjson", 1000), ("a.ndjson", 0), ("c.ndjson", 2000)):
        (folder / name).write_text("".join(f'{{"n": {first + i}, "pad": "{"x" * (i % 50)}"}}\n' + ("\n" if i % 97 == 0 else "") for i in range(700)))
    expected = list(range(700)) + list(range(1000, 1700)) + list(range(2000, 2700))
    for split in ("4k", "64k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = [r.n for r in numbered_lines(spark, str(folder)).select(F.get_json_object("value", "$.n").cast("int").alias("n"), "feed").orderBy("feed").collect()]
        assert got == expected, split
        feeds = sorted(r.feed for r in numbered_lines(spark, str(folder)).collect())
        assert feeds == sorted(set(feeds))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_failed_patients_make_and_parse_their_documents_once(spark, sf_dir):
    from carepanel.plans.resource_queries import failed_patients

    plan = failed_patients(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_custkey" not in plan
