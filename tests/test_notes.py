"""A synthetic discharge note with the awkward cases of headers, negation and titles."""

import re

import pytest
from pyspark.sql import functions as F

from carepanel.operators import notes as nt
from carepanel.plans import note_job

NOTE = """Seen by Dr. Example
CHIEF COMPLAINT:
Headache for two days.
CHIEF COMPLAINTS:
Chest pain.
HPI:
58-year-old with history of Type 2 Diabetes Mellitus. Denies chest pain. Possible heart failure.
Patient lives alone and cannot afford medication.
PAST MEDICAL HISTORY:
1. No history of heart failure
2. Hypertension but no kidney trouble
3. Chronic kidney disease
MEDICATIONS ON ADMISSION:
1. Metformin 1000mg twice daily
2. lisinopril 10 mg daily
3. Warfarin 2.5MG
Oxygen at home
ALLERGIES:
VITALS:
Penicillin rash
PMH:
Referral placed to o'brien's WOUND-care team. Referred to cardiology
Consult placed for nephrology.
FOLLOW-UP:
Primary care within 7 days
ok

Later text that is not part of the block
"""


@pytest.fixture(scope="module")
def note(spark):
    return spark.createDataFrame([(1, NOTE)], "note_id long, note_text string")


@pytest.fixture(scope="module")
def annotated(note):
    return nt.annotate(note).cache()


def parts(note, **kw):
    arr = note.select(nt.sections(F.col("note_text"), **kw).alias("s")).first().s
    return {s.section: s.section_text for s in arr}


def test_sections(note):
    got = parts(note)
    # "CHIEF COMPLAINT:" is no header by the strict list, so it stays in the text before the first one
    assert got["unknown"] == "Seen by Dr. Example\nCHIEF COMPLAINT:\nHeadache for two days."
    assert got["chief_complaint"] == "Chest pain."
    assert "allergies" not in got and got["physical_exam"] == "Penicillin rash"
    # the later PMH block replaces the earlier one
    assert got["past_medical_history"].startswith("Referral placed")
    assert got["follow_up"].endswith("not part of the block\n")
    lenient = parts(note, strict_headers=False)
    assert lenient["unknown"] == "Seen by Dr. Example" and lenient["chief_complaint"] == "Chest pain."


@pytest.mark.parametrize(
    "sentence, entity, section, expected",
    [
        ("No history of heart failure", "heart failure", "past_medical_history", "historical"),
        ("No history of heart failure", "heart failure", "chief_complaint", "negated"),
        ("Denies chest pain", "chest pain", "chief_complaint", "negated"),
        ("Denies fever but chest pain persists", "chest pain", "chief_complaint", "confirmed"),
        ("Possible COPD", "copd", "chief_complaint", "possible"),
        ("COPD", "copd", "past_medical_history", "historical"),
        ("nothing here", "copd", "past_medical_history", "confirmed"),
        ("no " + "x" * 60 + " copd", "copd", "chief_complaint", "confirmed"),
        ("Éno copd", "copd", "chief_complaint", "confirmed"),
    ],
)
def test_assertions(spark, sentence, entity, section, expected):
    df = spark.createDataFrame([(sentence, entity, section)], "s string, e string, x string")
    assert df.select(nt.assertion(F.col("s"), F.col("e"), F.col("x")).alias("a")).first().a == expected


def test_dictionary_tests_negation_before_history(annotated):
    r = annotated.first()
    assert {d.text: d.assertion for d in r.diagnoses} == {"Type 2 Diabetes": "historical"}
    # the window ignores sentences and lines: "No history of heart failure" and "no kidney trouble"
    # also reach the diagnoses on the lines below them
    assert r.negated_conditions == ["Hypertension", "Heart Failure", "CKD"]


def test_medications(annotated):
    got = [(m.name, m.dose, m.frequency) for m in annotated.first().medication_details]
    assert got == [
        ("Metformin", "1000mg", "twice daily"), ("unstructured",) * 3, ("Warfarin", "2.5MG", "unspecified"),
    ]
    assert [m.text for m in annotated.first().medications] == ["Metformin 1000mg twice daily", "lisinopril 10 mg daily", "Warfarin 2.5MG"]


def test_social_referrals_and_follow_ups(annotated):
    r = annotated.first()
    assert r.sdoh_signals == ["social_isolation", "financial_stress"]
    # "Referred to cardiology" ends with its line, not with a full stop, so it is no match
    assert r.referrals == ["Nephrology", "O'Brien'S Wound-Care Team"]
    assert r.follow_up_requirements == ["Primary care within 7 days"]


def test_flags_features_and_partition(annotated):
    flags = nt.readmission_flags(annotated).first().risk_flags
    assert flags[0].startswith("Patient lives alone") and flags[-1].startswith("2 referrals placed")
    f = nt.note_features(annotated).first().asDict()
    assert len(f) == 13 and f["nlp_has_nephropathy"] == 0 and f["nlp_complex_discharge"] == 1 and f["nlp_sdoh_risk_score"] == 2
    by = nt.by_assertion(annotated).first()
    assert by.confirmed == [] and by.historical == ["Type 2 Diabetes"]
    assert by.negated == ["CKD", "Heart Failure", "Hypertension"]
    assert by.social_risks[0] == "Lives alone / limited social support"


def test_lexicon_entities(note):
    r = nt.annotate(note, use_lexicon=True).first()
    assert "chest pain" in r.negated_conditions
    assert ("heart failure", "possible") in {(d.text, d.assertion) for d in r.diagnoses}
    f = nt.note_features(nt.annotate(note, use_lexicon=True)).first()
    assert f.nlp_denies_chest_pain == 1


def test_long_note_of_headers(spark):
    text = "\n".join(f"HPI:\nline {i}" for i in range(3000))
    df = spark.createDataFrame([(1, text)], "note_id long, note_text string")
    assert parts(df) == {"history_of_present_illness": "line 2999"}


def test_every_social_pattern_holds_an_anchor_outside_its_optional_parts():
    for category, patterns in nt.SOCIAL_PATTERNS.items():
        for pattern in patterns:
            fixed = re.sub(r"\([^)]*\)\??|.\?", "|", pattern)
            assert any(a in fixed for a in nt.SOCIAL_ANCHORS[category]), pattern


def test_social_anchors_change_no_result(spark):
    texts = ["He lives alone", "live alone", "affording medication", "lost work", "medication non compliance", "medicationnon-adherence",
             "ran out of it", "no cars", "a food desert", "dietary plan", "substance use disorder", "substance", "Homeless SHELTER", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("low", F.lower("t"))
    got = {r.i: r.s for r in df.select("i", nt.social_signals(F.col("low")).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == [c for c, ps in nt.SOCIAL_PATTERNS.items() if any(re.search(p, text.lower()) for p in ps)], text


def test_no_header_pattern_can_match_more_than_the_longest_header():
    assert nt.LONGEST_HEADER >= len("assessment and plan")
    assert not any(re.search(r"[*+{]", p) for table in (nt.SECTION_HEADERS, nt.LENIENT_HEADERS) for ps in table.values() for p in ps)


def test_note_job(spark, note, annotated, tmp_path):
    note_job.write_annotations(note, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/note_features")
    assert stored.first() == nt.note_features(annotated).first()
    assert spark.read.parquet(f"{tmp_path}/note_flags").count() == 1
