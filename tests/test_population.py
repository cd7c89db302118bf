"""Panel properties and agreement of the two ways to the worklist."""

import json

from conftest import rows
from pyspark.sql import functions as F

from carepanel.operators import care_gaps as cg
from carepanel.operators import measures as ms
from carepanel.operators import panel_views as pv
from carepanel.operators import population_report as rep
from carepanel.plans import population_job
from carepanel.sources import sinks
from carepanel.sources.fixture_views import view


def panel_of(spark, sf_dir):
    return population_job.scored_panel(view(spark, sf_dir, "population"))


def test_numerator_and_gaps_fill_the_denominator(spark, sf_dir):
    for r in ms.measure_counts(panel_of(spark, sf_dir)).collect():
        if not r.lower_is_better:
            assert r.numerator + r.gap_patient_count == r.denominator, r.measure_id


def test_summary_from_rows_equals_summary_from_gap_table(spark, sf_dir):
    panel = panel_of(spark, sf_dir)
    cols = ["patient_token", "num_gaps", "highest_priority", "gap_types", "top_action"]
    assert rows(cg.with_gap_summary(panel), *cols) == rows(cg.gap_summary(cg.care_gaps(panel)), *cols)
    assert rows(cg.daily_worklist(panel, 10)) == rows(cg.worklist_from_gaps(panel, cg.care_gaps(panel), 10))


def test_gap_load_matches_the_exploded_table(spark, sf_dir):
    panel = panel_of(spark, sf_dir)
    gaps = cg.care_gaps(panel)
    r = rep.gap_load(panel).first()
    assert (r.total_gaps, r.patients_with_gaps) == (gaps.count(), gaps.select("patient_token").distinct().count())


def test_sentinel_counts_as_overdue_and_bands_keep_their_edges(spark):
    ages = spark.createDataFrame([(a,) for a in (18, 19, 30, 31, 95, 96)], "age int")
    got = {r.band: r.patients for r in pv.age_histogram(ages).collect()}
    assert got == {"18-29": 2, "30-44": 1, "45-54": 0, "55-64": 0, "65-74": 0, "75+": 1}
    kept = {r.band: r.patients for r in pv.age_histogram(ages, keep_outside=True).collect()}
    assert kept["out_of_range"] == 2


def test_outputs(spark, sf_dir, tmp_path):
    written = population_job.write_outputs(view(spark, sf_dir, "population"), str(tmp_path), "2024-04-01T00:00:00")
    assert written == ["population_risk_stratified", "care_gaps", "daily_worklist", "hedis_measures_summary", "population_health_summary"]
    text = "".join(p.read_text() for p in (tmp_path / "population_health_summary").glob("part-*.json"))
    snapshot = json.loads(text)
    assert len(snapshot["hedis_measures"]) == 10
    assert sum(snapshot["risk_tier_counts"].values()) == snapshot["population_size"] == 150
    gaps = sinks.read_published(spark, str(tmp_path), "care_gaps")
    assert gaps.count() == snapshot["total_care_gaps"]
    assert gaps.agg(F.countDistinct("patient_token")).first()[0] == snapshot["patients_with_gaps"]
