"""Queries that publish tables through the sinks and read them back by the published manifest.

Each writes into a fresh folder under the shared checkpoint folder, so runs never meet, and returns what a reader of
the newest manifest sees; their twins are those of the queries whose rows they publish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from carepanel.plans import population_job, readmission_queries, resource_queries
from carepanel.sources import sinks
from carepanel.sources.fixture_views import view
from carepanel.sources.scratch import ensure_checkpoint_dir


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def versioned_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """A34: an older and then the current snapshot of the patient features; LATEST leads to the current one."""
    root = _scratch(spark, "a34")
    features = resource_queries.patient_features(spark, d)
    sinks.write_versioned(features.where("false"), root)
    sinks.write_versioned(features, root)
    return sinks.read_latest(spark, root)


def published_tables(spark: SparkSession, d: str) -> DataFrame:
    """C54: the four population tables published as one set; the care gaps read back from it."""
    root = _scratch(spark, "c54")
    population_job.write_outputs(view(spark, d, "population"), root, "2024-04-01T00:00:00")
    return sinks.read_published(spark, root, "care_gaps").drop("gap_order")


def bi_export(spark: SparkSession, d: str) -> DataFrame:
    """D61: the BI tables published as one set, empty ones left out; the patient-level facts read back from it."""
    root = _scratch(spark, "d61")
    tables = {
        "bi/patient_level": readmission_queries.bi_fact_rows(spark, d),
        "bi/tier_summary": readmission_queries.observed_tiers(spark, d),
    }
    sinks.write_tables(tables, root, skip_empty=True)
    return sinks.read_published(spark, root, "bi/patient_level")


QUERIES = {
    "a34_versioned_snapshot": versioned_snapshot,
    "c54_published_tables": published_tables,
    "d61_bi_export": bi_export,
}
