"""The population run: panel to risk, measures, gaps, worklist and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carepanel.operators import care_gaps, measures, population_report
from carepanel.operators.panel_risk import add_panel_risk, derive_panel_columns
from carepanel.sources import sinks


def scored_panel(panel: DataFrame) -> DataFrame:
    return add_panel_risk(derive_panel_columns(panel))


def write_outputs(panel: DataFrame, root: str, generated_at: str, capacity: int = 30) -> list[str]:
    """Write the scored panel once, then derive every other output from the stored copy."""
    spark = panel.sparkSession
    scored_panel(panel).write.mode("overwrite").parquet(f"{root}/scored_panel")
    stored = spark.read.parquet(f"{root}/scored_panel")
    table = measures.measure_table(measures.measure_counts(stored))
    tables = {
        "population_risk_stratified": stored,
        "care_gaps": care_gaps.in_urgency_order(care_gaps.care_gaps(stored)),
        "daily_worklist": care_gaps.daily_worklist(stored, capacity),
        "hedis_measures_summary": table,
    }
    written = sinks.write_tables(tables, root)
    snapshot = sinks.population_snapshot(stored, population_report.gap_totals(stored), table, generated_at)
    sinks.write_snapshot(snapshot, f"{root}/population_health_summary")
    return [*written, "population_health_summary"]
