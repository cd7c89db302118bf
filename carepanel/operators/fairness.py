"""Subgroup performance and fairness gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import rounded

# Smallest reliable group and labels that name no group.
MIN_SUBGROUP = 100
UNINFORMATIVE = ["Unknown", "Unknown/Invalid", "?", "None", "nan", ""]
ATTRIBUTES = ["race", "gender", "age_band"]


def age_band(midpoint: Column) -> Column:
    return F.when(midpoint.isNull(), "Unknown").when(midpoint < 50, "<50").when(midpoint < 70, "50-69").otherwise("70+")


def subgroup_metrics(scored: DataFrame, attributes: list[str], min_n: int = MIN_SUBGROUP) -> DataFrame:
    """One row per attribute and subgroup, all attributes in one pass.

    Input columns: probability, y_true, y_pred and the attributes. Rows are first combined map-side
    by (attribute, subgroup, probability, prediction), so a dominant subgroup is no hot spot.
    """
    tagged = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("subgroup")) for a in attributes]))
    y, pred = F.col("y_true").cast("long"), F.col("y_pred").cast("long")
    points = (
        scored.select(tagged.alias("g"), rounded("probability", 4).alias("p"), y.alias("y"), pred.alias("pred"))
        .select("g.*", "p", "y", "pred")
        .where(F.col("subgroup").isNotNull() & ~F.col("subgroup").isin(UNINFORMATIVE))
        .groupBy("attribute", "subgroup", "p", "pred")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )
    below = Window.partitionBy("attribute", "subgroup").orderBy("p").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Rows sharing p (one per prediction) are tied, so they count half of each other's negatives too.
    tied = Window.partitionBy("attribute", "subgroup", "p")
    points = points.withColumn("neg_tied", F.sum("neg").over(tied)).withColumn("neg_upto", F.sum("neg").over(below))
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg_tied") / 2))
    flagged = F.col("pred") == 1
    counted = points.groupBy("attribute", "subgroup").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum("pos").alias("_pos"),
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("_auroc"),
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("_tp"),
        F.sum(F.when(flagged, F.col("pos") + F.col("neg")).otherwise(0)).alias("_flagged"),
    )
    n = F.col("n")
    tpr = F.try_divide(F.col("_tp").cast("double"), F.col("_pos"))
    return counted.select(
        "attribute",
        "subgroup",
        n,
        (n >= min_n).alias("reliable"),
        rounded(F.col("_pos").cast("double") / n, 4).alias("positive_rate"),
        rounded("_auroc", 4).alias("auroc"),
        rounded(tpr, 4).alias("recall_tpr"),
        rounded(1 - tpr, 4).alias("fnr"),
        rounded(F.col("_flagged").cast("double") / n, 4).alias("selection_rate"),
    )


def in_report_order(table: DataFrame) -> DataFrame:
    return table.orderBy("attribute", F.desc("n"), "subgroup")


def fairness_gaps(table: DataFrame) -> DataFrame:
    """Spread of recall and selection rate over reliable subgroups, and the group missed most."""

    def spread(column: str) -> Column:
        wide = F.max(column) - F.min(column)
        return rounded(F.when(F.count(column) > 1, wide).otherwise(0.0), 4)

    worst = F.max_by("subgroup", F.when(F.col("fnr").isNotNull(), F.struct("fnr", "n", "subgroup")))
    reliable = F.col("reliable")
    only = lambda c: F.when(reliable, F.col(c))
    marked = table.select("attribute", "subgroup", "n", *[only(c).alias(c) for c in ("recall_tpr", "selection_rate", "fnr")])
    return marked.groupBy("attribute").agg(
        spread("recall_tpr").alias("equal_opportunity_diff"),
        spread("selection_rate").alias("demographic_parity_diff"),
        worst.alias("worst_fnr_subgroup"),
        rounded(F.max("fnr"), 4).alias("worst_fnr"),
    )


def audit_frame(features: DataFrame, scores: DataFrame, patient: str, target: str) -> DataFrame:
    """Features joined to scores, with the age band and the columns the audit reads."""
    predictions = scores.select(F.col("patient_id").alias(patient), "probability", F.col("predicted_label").alias("y_pred"))
    return features.join(predictions, patient).withColumns({"y_true": F.col(target), "age_band": age_band(F.col("age_midpoint"))})


def report(table: DataFrame) -> DataFrame:
    """One row per attribute: its subgroup records (largest first) and its gaps, ready for JSON."""
    record = F.struct("n", *[c for c in table.columns if c not in ("attribute", "n")])
    records = table.groupBy("attribute").agg(F.sort_array(F.collect_list(record), asc=False).alias("subgroups"))
    return records.join(fairness_gaps(table), "attribute")


def group_view(table: DataFrame) -> DataFrame:
    """Dashboard columns of the subgroup table."""
    # Displayed names.
    names = {
        "subgroup": "group",
        "n": "patients",
        "positive_rate": "actual_readmit_rate",
        "auroc": "ranking_quality",
        "recall_tpr": "high_risk_caught",
        "fnr": "high_risk_missed",
        "selection_rate": "flagged_rate",
    }
    return table.select("attribute", *[F.col(c).alias(out) for c, out in names.items()])


def worst_group_statement(gaps: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit("The model misses the most readmissions in the "),
        F.col("worst_fnr_subgroup"),
        F.lit(" group - about "),
        F.rint(F.col("worst_fnr") * 100).cast("int").cast("string"),
        F.lit("% go unflagged."),
    )
    return gaps.select("attribute", "equal_opportunity_diff", "demographic_parity_diff", text.alias("statement"))
