"""Risk score, quantile tiers and tier summaries of model probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import clamp, rounded, sure_flag

# Tier names from the top, and the quantiles that cut them.
TIERS = ["High", "Medium", "Low"]
MEDIUM_QUANTILE, HIGH_QUANTILE = 0.50, 0.80
EXPORT_COLUMNS = ["patient_id", "risk_score", "tier", "top_3_risk_factors", "probability", "predicted_label"]


def risk_score(probability: Column | str) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return clamp(F.rint(p * 100), 0.0, 100.0).cast("int")


def tier_cuts(scored: DataFrame) -> DataFrame:
    """Medium and high cut of the integer score (at most 101 distinct values, so exact is cheap)."""
    cuts = F.percentile("risk_score", F.array(F.lit(MEDIUM_QUANTILE), F.lit(HIGH_QUANTILE)))
    return scored.agg(cuts.alias("c")).select(F.col("c")[0].alias("medium_cut"), F.col("c")[1].alias("high_cut"))


def assign_tiers(scored: DataFrame, cuts: tuple[float, float] | None = None) -> DataFrame:
    """High, Medium or Low; a score on a cut goes up. Cuts come from the data unless supplied."""
    if cuts:
        medium, high = F.lit(cuts[0]), F.lit(cuts[1])
    else:
        pair = tier_cuts(scored).select(F.struct("medium_cut", "high_cut")).scalar()
        medium, high = pair["medium_cut"], pair["high_cut"]
    s = F.col("risk_score")
    return scored.withColumn("tier", F.when(s >= high, "High").when(s >= medium, "Medium").otherwise("Low"))


def score_frame(predictions: DataFrame, cuts: tuple[float, float] | None = None) -> DataFrame:
    """Adds score and tier, rounds the probability to 4 decimals and labels it at 0.5."""
    scored = predictions.withColumn("risk_score", risk_score("probability"))
    scored = scored.withColumn("probability", rounded("probability", 4))
    return assign_tiers(scored, cuts).withColumn("predicted_label", sure_flag(F.col("probability") >= 0.5))


def exact_percentages(
    counted: DataFrame, order: str, count: str = "patients", decimals: int = 1, out: str = "pct_of_panel"
) -> DataFrame:
    """Percentages that add up to exactly 100, by largest remainder (earlier rows win ties).

    For small aggregates only: the whole table is one window.
    """
    every = Window.partitionBy(F.lit(0))
    scale = float(10**decimals)
    raw = F.col(count).cast("double") / F.col("_total") * 100 * scale
    ranked = (
        counted.withColumn("_total", F.sum(count).over(every))
        .withColumn("_raw", F.when(F.col("_total") > 0, raw).otherwise(0.0))
        .withColumn("_floor", F.floor("_raw").cast("double"))
        .withColumn("_left", F.rint(scale * 100 - F.sum("_floor").over(every)))
        .withColumn("_rank", F.row_number().over(every.orderBy(F.desc(F.col("_raw") - F.col("_floor")), F.asc(order))))
    )
    extra = F.when((F.col("_total") > 0) & (F.col("_rank") <= F.col("_left")), 1.0).otherwise(0.0)
    pct = (F.col("_floor") + extra) / scale
    return ranked.withColumn(out, pct).drop("_total", "_raw", "_floor", "_left", "_rank")


def tier_position(tier: Column | str = "tier") -> Column:
    t = F.col(tier) if isinstance(tier, str) else tier
    return F.array_position(F.array(*[F.lit(x) for x in TIERS]), t) - 1


def tier_summary(scores: DataFrame, actual: str | None = None) -> DataFrame:
    """Patients, mean score, mean probability and panel share per tier; optionally the observed rate."""
    aggs = [
        F.count("*").alias("patients"),
        rounded(F.avg("risk_score"), 1).alias("mean_score"),
        rounded(F.avg("probability"), 4).alias("mean_probability"),
    ]
    if actual:
        aggs.append(rounded(F.avg(actual), 4).alias("actual_readmit_rate"))
    summary = scores.groupBy("tier").agg(*aggs).withColumn("position", tier_position())
    return exact_percentages(summary, "position").orderBy("position")


def score_export(scores: DataFrame) -> DataFrame:
    return scores.select(*EXPORT_COLUMNS).orderBy(F.desc("risk_score"), "patient_id")
