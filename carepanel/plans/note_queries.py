"""Registered queries over clinical notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepanel.functions.arrays import to_rows
from carepanel.operators import lexicon as lx
from carepanel.operators import notes as nt
from carepanel.plans.note_job import spread
from carepanel.sources.fixture_views import view


def _notes(spark, d):
    return spread(view(spark, d, "notes"))


def _lower(spark, d):
    return _notes(spark, d).select("note_id", F.lower("note_text").alias("low"))


def _joined(column):
    return F.array_join(column, " | ")


def section_lines(spark, d):
    marked = F.transform(F.split("note_text", "\n", -1), lambda line: nt.section_of_line(line))
    return to_rows(_notes(spark, d), marked, "note_id", alias="section", position="line_no")


def section_rows(spark, d):
    return to_rows(_notes(spark, d), nt.sections(F.col("note_text")), "note_id", alias="s").select("note_id", "s.*")


def sentence_assertions(spark, d):
    """Every sentence of the note's own opening lines and text, asserted for one entity in two sections."""
    sentences = to_rows(_notes(spark, d), nt.find_all(F.col("note_text"), nt.SENTENCE), "note_id", alias="s", position="n")
    term = F.lit("a")
    return sentences.select(
        "note_id",
        "n",
        nt.assertion(F.col("s"), term, F.lit("chief_complaint")).alias("elsewhere"),
        nt.assertion(F.col("s"), term, F.lit(nt.HISTORY_SECTION)).alias("in_history"),
    )


def entity_rows(spark, d):
    """Every lexicon term in each sentence of the diagnostic sections, terms inside longer ones too: the lexicon is a
    table, joined by token n-grams."""
    lexicon = lx.lexicon_of_pairs(spark, nt.default_lexicon())
    return lx.lexicon_entities(_notes(spark, d), lexicon, resolve="all")


def longest_entity_rows(spark, d):
    """Entities as non-overlapping spans, the longest term at each place, as an entity recogniser gives them."""
    lexicon = lx.lexicon_of_pairs(spark, nt.default_lexicon())
    return lx.lexicon_entities(_notes(spark, d), lexicon, resolve="longest")


def social(spark, d):
    return _lower(spark, d).select("note_id", _joined(nt.social_signals(F.col("low"))).alias("sdoh_signals"))


def referral_lists(spark, d):
    return _lower(spark, d).select("note_id", _joined(nt.referrals(F.col("low"))).alias("referrals"))


def follow_up_lists(spark, d):
    return _notes(spark, d).select("note_id", _joined(nt.follow_ups(F.col("note_text"))).alias("follow_ups"))


def medication_rows(spark, d):
    annotated = nt.annotate(_notes(spark, d))
    rows = to_rows(annotated, F.col("medication_details"), "note_id", alias="m", position="n")
    return rows.select("note_id", "n", "m.name", "m.dose", "m.frequency", "m.original_text")


def medication_lines(spark, d):
    """The medication parser over every line of every note."""
    rows = to_rows(_notes(spark, d), nt.medications(F.col("note_text")), "note_id", alias="m", position="n")
    return rows.select("note_id", "n", "m.name", "m.dose", "m.frequency", "m.original_text")


def medication_entities(spark, d):
    rows = to_rows(nt.annotate(_notes(spark, d)), F.col("medications"), "note_id", alias="e")
    return rows.select("note_id", "e.text", "e.entity_type", "e.assertion", "e.section")


def dictionary(spark, d):
    findings = nt.dictionary_findings(F.col("low"))
    return to_rows(_lower(spark, d), findings, "note_id", alias="f").select("note_id", "f.*")


def results(spark, d):
    annotated = nt.annotate(_notes(spark, d))
    names = F.transform("diagnoses", lambda e: F.concat(e["text"], F.lit(":"), e["assertion"]))
    return annotated.select(
        "note_id",
        F.size("sections").alias("num_sections"),
        _joined(names).alias("diagnoses"),
        _joined(F.col("negated_conditions")).alias("negated_conditions"),
        _joined(F.transform("medications", lambda m: m["text"])).alias("medications"),
        _joined(F.col("sdoh_signals")).alias("sdoh_signals"),
        _joined(F.col("referrals")).alias("referrals"),
        _joined(F.col("follow_up_requirements")).alias("follow_ups"),
    )


def by_assertion(spark, d):
    lists = nt.by_assertion(nt.annotate(_notes(spark, d)))
    return lists.select("note_id", *[_joined(F.col(c)).alias(c) for c in lists.columns if c != "note_id"])


def flags(spark, d):
    return nt.readmission_flags(nt.annotate(_notes(spark, d))).select("note_id", _joined(F.col("risk_flags")).alias("risk_flags"))


QUERIES = {
    "b01_section_headers": section_lines,
    "b02_sections": section_rows,
    "b03_assertions": sentence_assertions,
    "b04_lexicon_entities": entity_rows,
    "b04_longest_entities": longest_entity_rows,
    "b05_social_signals": social,
    "b06_referrals": referral_lists,
    "b07_follow_ups": follow_up_lists,
    "b08_medications": medication_rows,
    "b08_medication_lines": medication_lines,
    "b09_medication_entities": medication_entities,
    "b10_dictionary_diagnoses": dictionary,
    "b11_note_results": results,
    "b12_by_assertion": by_assertion,
    "b13_readmission_flags": flags,
    "b14_note_features": lambda s, d: nt.note_features(nt.annotate(_notes(s, d))),
    "b14_note_features_lexicon": lambda s, d: nt.note_features(nt.annotate(_notes(s, d), use_lexicon=True)),
}
