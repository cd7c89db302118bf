"""The readmission run: raw encounters to features, models, scores, audit and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.operators import bi_export, cleaning, curves, drivers, fairness, modeling, scoring
from carepanel.operators import encounter_features as ef
from carepanel.sources import sinks
from carepanel.sources.encounters import coerce_numbers
from carepanel.sources.schemas import ENCOUNTER_NUMBERS
from carepanel.sources.scratch import settled

PATIENT, TARGET = cleaning.PATIENT, cleaning.TARGET


def scored_patients(features: DataFrame, kind: str, explain_with: modeling.PipelineModel, **overrides) -> DataFrame:
    """Out-of-fold scores with tiers and the top risk factors of every patient.

    Factors are the exact contributions of the logistic model, whichever model gave the score. They are made in the
    pass that scores a row and stored with the prediction, so the tier cuts read stored rows and nothing is joined.
    """
    terms = modeling.linear_terms(explain_with, features)
    explained = drivers.with_contributions(features, terms).withColumn("top_3_risk_factors", drivers.top_phrases())
    predicted = modeling.out_of_fold(explained.drop("contributions"), PATIENT, TARGET, kind, keep=("top_3_risk_factors",), **overrides)
    return scoring.score_frame(settled(predicted.select(F.col(PATIENT).alias("patient_id"), "probability", "top_3_risk_factors")))


def run(raw: DataFrame, root: str, options: dict[str, dict] | None = None) -> list[str]:
    """Run everything and write it under ``root``. ``options`` overrides estimator parameters by kind.

    Number columns that are still text, as in the raw file, are read as numbers first.

    Features and scores are written once and read back, since every later step scans them again.
    """
    spark = raw.sparkSession
    options = options or {}
    raw = coerce_numbers(raw, [c for c, kind in raw.dtypes if kind == "string" and c in ENCOUNTER_NUMBERS])
    # Caps and frequent levels are aggregates over the deduplicated rows. Storing those rows means the
    # shuffle by patient happens once, not once more per aggregate.
    cleaning.usable_first_encounters(raw).write.mode("overwrite").parquet(f"{root}/first_encounters")
    first = spark.read.parquet(f"{root}/first_encounters")
    ef.build_features(cleaning.finish(first)).write.mode("overwrite").parquet(f"{root}/features")
    features = spark.read.parquet(f"{root}/features")

    metrics, models = modeling.compare_models(features, PATIENT, TARGET, options)
    metrics.write.mode("overwrite").parquet(f"{root}/model_metrics")
    metrics = spark.read.parquet(f"{root}/model_metrics")
    champion = curves.champion(metrics)
    size = features.agg(F.count("*").alias("n_rows"), F.round(F.avg(TARGET), 4).alias("positive_rate"))
    document = bi_export.metrics_document(metrics, champion, size)
    kind = champion.first()["champion"]
    modeling.save_run(models, kind, document, root)

    scores = scored_patients(features, kind, models["logreg"], **options.get(kind, {}))
    scores.write.mode("overwrite").parquet(f"{root}/scores")
    scores = spark.read.parquet(f"{root}/scores")

    labelled = curves.scores_with_labels(scores, features, PATIENT, TARGET)
    audited = fairness.audit_frame(features, scores, PATIENT, TARGET)
    fairness.subgroup_metrics(audited, fairness.ATTRIBUTES).write.mode("overwrite").parquet(f"{root}/subgroups")
    subgroups = spark.read.parquet(f"{root}/subgroups")
    terms = modeling.linear_terms(models["logreg"], features)
    wide = bi_export.patient_level(scores, features, PATIENT, TARGET)
    fairness.report(subgroups).write.mode("overwrite").json(f"{root}/fairness_report")
    tables = {
        "patient_risk_scores": scoring.score_export(scores),
        "threshold_sweep": curves.sweep(labelled).orderBy("threshold"),
        "global_importance": drivers.global_importance(drivers.with_contributions(features, terms), terms),
        "bi/patient_level": wide,
        "bi/tier_summary": scoring.tier_summary(wide, actual="actual_readmit_30d"),
        "bi/fairness_long": fairness.in_report_order(subgroups),
        "bi/model_metrics": bi_export.flatten_metrics(spark.read.text(f"{root}/metrics")),
    }
    return sinks.write_tables(tables, root, skip_empty=True)
