"""DuckDB twins of the registered queries, written separately from the Spark code."""

from duckcheck import export_checks, ingest_checks, model_checks, note_checks, population_checks, readmission_checks, resource_checks

MODULES = [resource_checks, note_checks, population_checks, readmission_checks, model_checks, export_checks, ingest_checks]


def all_checks() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.CHECKS.items()}
