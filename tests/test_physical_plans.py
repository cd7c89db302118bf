"""Plan properties that decide whether a query survives at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from carepanel.operators import cleaning, measures
from carepanel.operators import resources as rs
from carepanel.operators.panel_risk import derive_panel_columns
from carepanel.plans.catalog import all_queries
from carepanel.plans.model_queries import QUERIES as MODEL_QUERIES
from carepanel.sources.fixture_views import view

NAMES = sorted(set(all_queries()) - set(MODEL_QUERIES))


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python_worker(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert node not in text, f"{name} plans a {node}"


def test_top_rows_per_patient_are_cut_before_the_shuffle(spark, sf_dir):
    for df in (
        rs.latest_observations(view(spark, sf_dir, "observations")),
        rs.latest_encounters(view(spark, sf_dir, "encounters")),
        cleaning.first_encounters(view(spark, sf_dir, "admissions")),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit (") >= 2


def test_gaps_and_gap_lists_do_not_shuffle(spark, sf_dir):
    queries = entry.queries()
    for name in ("c20_gap_patients", "b11_note_results", "b04_lexicon_entities", "a03_condition_codings"):
        text = plan(queries[name](spark, sf_dir))
        joins = "Exchange hashpartitioning" in text
        assert not joins, name


def test_measures_take_one_pass(spark, sf_dir):
    panel = entry.queries()["c01_derived_columns"]
    text = plan(measures.measure_counts(derive_panel_columns(view(spark, sf_dir, "population"))))
    assert text.count("Scan parquet") == plan(panel(spark, sf_dir)).count("Scan parquet")
    assert "Exchange hashpartitioning" not in text


def test_scans_read_only_needed_columns(spark, sf_dir):
    text = plan(entry.queries()["c51_intervention_targets"](spark, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_cleaned_rows_are_kept_for_caps_and_levels(spark, sf_dir):
    spark.catalog.clearCache()
    features = entry.queries()["d21_feature_table"](spark, sf_dir)
    features.count()
    text = plan(features)
    above = text.split("InMemoryRelation")[0]
    assert "InMemoryTableScan" in above and "Scan parquet" not in above
