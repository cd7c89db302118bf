"""Classifier metrics and threshold curves.

The sweep and the fairness tables start from ``curve_points``: positives and negatives per 4-decimal probability.
That aggregate has at most 10 001 rows per group whatever the data size, so the running sums that follow
are windows over small tables. ``evaluate`` works on the probabilities as they are: running sums inside each of
10 001 bins, on top of the totals of the bins before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import rounded

# Default cut-off and relative cost of a missed readmission.
DEFAULT_THRESHOLD = 0.5
COST_FN, COST_FP = 10.0, 1.0
SWEEP_STEPS = 101


def curve_points(scored: DataFrame, label: str = "y_true", groups: tuple[str, ...] = ()) -> DataFrame:
    return (
        scored.select(*groups, rounded("probability", 4).alias("p"), F.col(label).cast("long").alias("y"))
        .groupBy(*groups, "p")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )


def exact_points(scored: DataFrame, label: str, groups: tuple[str, ...]) -> DataFrame:
    """Positives and negatives of each probability, the negatives below it, and both classes from it upwards."""
    points = (
        scored.select(*groups, F.col("probability").alias("p"), F.col(label).cast("long").alias("y"))
        .groupBy(*groups, "p")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
        .withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(10_000), F.floor(F.col("p") * 10_000))).cast("int"))
    )
    bins = points.groupBy(*groups, "bin").agg(F.sum("pos").alias("bin_pos"), F.sum("neg").alias("bin_neg"))
    all_bins = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = all_bins.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    after = all_bins.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    over = lambda c, window: F.coalesce(F.sum(c).over(window), F.lit(0))
    bases = bins.select(
        *groups, "bin", over("bin_neg", before).alias("neg_base"), over("bin_pos", after).alias("tp_base"), over("bin_neg", after).alias("fp_base")
    )
    inside = Window.partitionBy(*groups, "bin")
    rising = inside.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    falling = inside.orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    placed = points.withColumns({"neg_in": over("neg", rising), "tp_in": F.sum("pos").over(falling), "fp_in": F.sum("neg").over(falling)})
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*groups, "bin")]
    return placed.alias("x").join(bases.alias("b"), same).select(
        *(F.col(f"x.{c}") for c in (*groups, "p", "pos", "neg")),
        (F.col("neg_base") + F.col("neg_in")).alias("neg_below"),
        (F.col("tp_base") + F.col("tp_in")).alias("tp_here"),
        (F.col("fp_base") + F.col("fp_in")).alias("fp_here"),
    )


def _auroc() -> Column:
    """Share of positive/negative pairs ranked right, ties counting half; null with one class only."""
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg"))


def _average_precision() -> Column:
    """Step-wise area: precision at each probability weighted by the recall it adds."""
    step = F.col("pos") * F.col("tp_here") / (F.col("tp_here") + F.col("fp_here"))
    return F.try_divide(F.sum(step), F.sum("pos").cast("double"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def evaluate(
    scored: DataFrame, label: str = "y_true", threshold: float = DEFAULT_THRESHOLD, groups: tuple[str, ...] = ()
) -> DataFrame:
    """All metrics of a scored table (per group), from one aggregation of the rows."""
    points = exact_points(scored, label, groups)
    p, pos, neg = F.col("p"), F.col("pos"), F.col("neg")
    flagged = p >= threshold
    total = lambda c, when: F.coalesce(F.sum(F.when(when, c)), F.lit(0))
    loss = F.sum(pos * F.pow(p - 1, F.lit(2)) + neg * F.pow(p, F.lit(2)))
    measured = points.groupBy(*groups).agg(
        rounded(_auroc(), 4).alias("auroc"),
        rounded(_average_precision(), 4).alias("pr_auc"),
        rounded(F.try_divide(loss, F.sum(pos + neg)), 4).alias("brier"),
        total(pos, flagged).alias("tp"),
        total(neg, flagged).alias("fp"),
        total(pos, ~flagged).alias("fn"),
        total(neg, ~flagged).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    share = lambda a, b: rounded(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)), 4)
    return measured.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": rounded(_f1(tp, fp, fn), 4),
            "threshold": F.lit(threshold),
        }
    )


def champion(metrics: DataFrame, order: str = "model_order") -> DataFrame:
    """The model with the best PR-AUC; the first listed wins a tie."""
    best = F.max_by("model", F.struct(F.col("pr_auc"), -F.col(order)))
    return metrics.agg(best.alias("champion"))


def _steps(spark, steps: int) -> DataFrame:
    k = F.col("id")
    return spark.range(steps).select(k.cast("int").alias("k"), (k * F.lit(1.0 / (steps - 1))).alias("t"))


def sweep(scored: DataFrame, label: str = "y_true", steps: int = SWEEP_STEPS) -> DataFrame:
    """Confusion counts and rates at ``steps`` cut-offs from 0 to 1.

    Each probability belongs to the highest cut-off it reaches, so the curve is a cumulative sum over
    ``steps`` rows; no probability is paired with every cut-off.
    """
    width = 1.0 / (steps - 1)
    p = F.col("p")
    near = F.floor(p / width)
    reaches = lambda k: p >= k * F.lit(width)
    cut = F.when(reaches(near + 1), near + 1).when(reaches(near), near).otherwise(near - 1)
    reached = (
        curve_points(scored, label)
        .groupBy(F.least(cut, F.lit(steps - 1)).cast("int").alias("k"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    every = Window.partitionBy(F.lit(0))
    from_top = every.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    filled = _steps(scored.sparkSession, steps).join(reached, "k", "left").fillna(0, ["pos", "neg"])
    counted = filled.select(
        rounded("t", 3).alias("threshold"),
        F.sum("pos").over(from_top).alias("tp"),
        F.sum("neg").over(from_top).alias("fp"),
        F.sum("pos").over(every).alias("_p"),
        F.sum("neg").over(every).alias("_n"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn, flagged = F.col("_p") - tp, tp + fp
    return counted.select(
        "threshold",
        tp,
        fp,
        fn.alias("fn"),
        (F.col("_n") - fp).alias("tn"),
        rounded(F.try_divide(tp.cast("double"), flagged), 4).alias("precision"),
        rounded(F.coalesce(F.try_divide(tp.cast("double"), F.col("_p")), F.lit(0.0)), 4).alias("recall"),
        rounded(_f1(tp, fp, fn), 4).alias("f1"),
        flagged.alias("flagged"),
        rounded(F.try_divide(flagged.cast("double"), F.col("_p") + F.col("_n")) * 100, 2).alias("flagged_pct"),
    )


def recommended_threshold(swept: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """The cheapest row of the sweep; the lowest cut-off wins a tie."""
    cost = F.col("fn") * cost_fn + F.col("fp") * cost_fp
    return swept.withColumn("total_cost", cost).orderBy("total_cost", "threshold").limit(1)


def nearest_row(swept: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return swept.orderBy(F.abs(F.col("threshold") - threshold), "threshold").limit(1)


def precision_recall_points(swept: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """Operating points with a defined precision, each with its recall change against the default cut-off."""
    default = nearest_row(swept).select("recall").scalar()
    best = recommended_threshold(swept, cost_fn, cost_fp).select("threshold").scalar()
    return swept.where(F.col("precision").isNotNull()).select(
        "threshold",
        "recall",
        "precision",
        rounded((F.col("recall") - default) * 100, 2).alias("recall_change_pts"),
        (F.col("threshold") == best).alias("recommended"),
    )


def scores_with_labels(scores: DataFrame, features: DataFrame, patient: str, target: str) -> DataFrame:
    """Scores joined to true outcomes on the patient id; both sides hold one row per patient."""
    labels = features.select(F.col(patient).alias("patient_id"), F.col(target).alias("y_true"))
    return scores.join(labels, "patient_id")
