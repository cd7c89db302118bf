"""Wide and small tables for BI tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import sure_flag
from carepanel.operators.encounter_features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from carepanel.operators.fairness import age_band

METRIC_FIELDS = ["auroc", "pr_auc", "recall", "precision", "f1", "brier"]
METRICS_SCHEMA = (
    "n_rows BIGINT, positive_rate DOUBLE, champion STRING, models MAP<STRING, STRUCT<auroc: DOUBLE, pr_auc: DOUBLE, "
    "brier: DOUBLE, precision: DOUBLE, recall: DOUBLE, f1: DOUBLE, threshold: DOUBLE, "
    "confusion_matrix: STRUCT<tn: BIGINT, fp: BIGINT, fn: BIGINT, tp: BIGINT>>>"
)


def patient_level(scores: DataFrame, features: DataFrame, patient: str, target: str) -> DataFrame:
    """One wide row per scored patient; a patient without features keeps a row."""
    facts = features.withColumnRenamed(patient, "patient_id").withColumnRenamed(target, "actual_readmit_30d")
    joined = scores.join(facts, "patient_id", "left")
    predicted, actual = F.col("predicted_label"), F.col("actual_readmit_30d")
    quadrant = (
        F.when((predicted == 1) & (actual == 1), "True Positive")
        .when((predicted == 1) & (actual == 0), "False Positive")
        .when((predicted == 0) & (actual == 1), "False Negative")
        .otherwise("True Negative")
    )
    dimensions = [c for c in CATEGORICAL_FEATURES + NUMERIC_FEATURES if c in joined.columns]
    return joined.select(
        "patient_id",
        "risk_score",
        "tier",
        "probability",
        "predicted_label",
        "actual_readmit_30d",
        sure_flag(predicted == actual).alias("prediction_correct"),
        quadrant.alias("outcome_quadrant"),
        "top_3_risk_factors",
        age_band(F.col("age_midpoint")).alias("age_band"),
        *dimensions,
    )


def fairness_long(tables: list[DataFrame]) -> DataFrame:
    """Subgroup tables of several attributes stacked into one."""
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t)
    return stacked


def metrics_document(metrics: DataFrame, champion: DataFrame, n_rows: DataFrame) -> DataFrame:
    """Model metrics as one JSON document: a row per model in, one text row out."""
    matrix = F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix")
    entry = F.struct("model", F.struct("auroc", "pr_auc", "brier", "precision", "recall", "f1", "threshold", matrix))
    models = metrics.agg(F.map_from_entries(F.collect_list(entry)).alias("models"))
    size = n_rows.select(F.struct("n_rows", "positive_rate")).scalar()
    document = F.struct(
        size["n_rows"].alias("n_rows"),
        size["positive_rate"].alias("positive_rate"),
        champion.select("champion").scalar().alias("champion"),
        "models",
    )
    return models.select(F.to_json(document).alias("value"))


def flatten_metrics(document: DataFrame, column: str = "value") -> DataFrame:
    """One row per model of a metrics document, the champion flagged."""
    parsed = document.select(F.from_json(column, METRICS_SCHEMA).alias("d"))
    models = parsed.select("d.champion", F.explode("d.models").alias("model", "m"))
    return models.select(
        "model",
        F.equal_null(F.col("model"), F.col("champion")).alias("is_champion"),
        *[F.col(f"m.{f}").alias(f) for f in METRIC_FIELDS],
    )


def champion_confusion(document: DataFrame, column: str = "value") -> DataFrame:
    parsed = document.select(F.from_json(column, METRICS_SCHEMA).alias("d"))
    models = parsed.select("d.champion", F.explode("d.models").alias("model", "m"))
    cm = F.col("m.confusion_matrix")
    return models.where(F.col("model") == F.col("champion")).select(
        "model",
        cm["tp"].alias("correctly_flagged"),
        cm["fn"].alias("missed"),
        cm["fp"].alias("false_alarms"),
        cm["tn"].alias("correctly_cleared"),
    )
