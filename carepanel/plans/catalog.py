"""All registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carepanel.plans import export_queries, ingest_queries, model_queries, note_queries, population_queries, readmission_queries, resource_queries

MODULES = [resource_queries, note_queries, population_queries, readmission_queries, model_queries, export_queries, ingest_queries]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_queries()["c36_c38_daily_worklist"](spark, sf_dir)
