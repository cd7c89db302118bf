"""The recurring outreach queue and the panel queries around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import percent
from carepanel.operators.quality import unfold
from carepanel.operators.scoring import EXPORT_COLUMNS, TIERS, exact_percentages

# Days between contacts per tier, for any other tier, and the order of the queue.
CADENCE_DAYS = {"High": 7, "Medium": 30, "Low": 90}
NO_CADENCE = 9999
STATUS_ORDER = ["Overdue", "New", "Due"]
QUEUE_COLUMNS = ["patient_id", "risk_score", "tier", "status", "last_contacted", "next_due", "why"]
BAND_WIDTH = 5


def contact_status(scores: DataFrame, contact_log: DataFrame, as_of: str, cadence: dict[str, int] | None = None) -> DataFrame:
    """Every patient with last contact, next due date and status on the given day."""
    days = F.create_map(*[F.lit(x) for pair in (cadence or CADENCE_DAYS).items() for x in pair])
    joined = scores.join(contact_log.select("patient_id", "last_contacted"), "patient_id", "left")
    today, due = F.lit(as_of).cast("date"), F.col("next_due")
    status = (
        F.when(F.col("last_contacted").isNull(), "New")
        .when(due < today, "Overdue")
        .when(due <= today, "Due")
        .otherwise("Scheduled")
    )
    with_due = joined.withColumn("cadence_days", F.coalesce(F.try_element_at(days, F.col("tier")), F.lit(NO_CADENCE)))
    with_due = with_due.withColumn("next_due", F.date_add("last_contacted", F.col("cadence_days")))
    return with_due.withColumn("status", status)


def queue_counts(status: DataFrame) -> DataFrame:
    is_status = lambda s: F.count_if(F.col("status") == s)
    return status.agg(
        F.count_if(F.col("status") != "Scheduled").alias("due_today"),
        is_status("Overdue").alias("overdue"),
        is_status("New").alias("never_contacted"),
        is_status("Scheduled").alias("scheduled"),
    )


def outreach_queue(status: DataFrame, cap: int | None = 30) -> DataFrame:
    """Patients to call: overdue, then new, then due, each by risk; optionally the first ``cap``."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    queue = status.where(rank > 0).orderBy(rank, F.desc("risk_score"), "patient_id")
    queue = queue if cap is None else queue.limit(cap)
    return queue.withColumn("why", F.col("top_3_risk_factors")).select(*QUEUE_COLUMNS)


def tier_counts(scores: DataFrame) -> DataFrame:
    """Patients per tier, zero-filled, with percentages that add up to 100."""
    counted = scores.agg(*[F.count_if(F.col("tier") == t).alias(t) for t in TIERS])
    rows = [[F.lit(i), F.lit(t), F.col(t)] for i, t in enumerate(TIERS)]
    return exact_percentages(unfold(counted, rows, ["position", "tier", "patients"]), "position")


def score_bands(scores: DataFrame, keep_outside: bool = False) -> DataFrame:
    """Five-point score bands, closed on the left; a score of 100 is outside the last band."""
    starts = list(range(0, 100, BAND_WIDTH))
    band = F.floor(F.col("risk_score") / BAND_WIDTH) * BAND_WIDTH
    counted = scores.select(band.alias("lo")).groupBy("lo").agg(F.count("*").alias("patients"))
    bands = scores.sparkSession.range(0, 105 if keep_outside else 100, BAND_WIDTH).withColumnRenamed("id", "lo")
    filled = bands.join(counted, "lo", "left").fillna(0, ["patients"])
    label = F.concat(F.col("lo").cast("string"), F.lit("-"), (F.col("lo") + BAND_WIDTH).cast("string"))
    label = F.when(F.col("lo") > starts[-1], "out_of_range").otherwise(label)
    return exact_percentages(filled.withColumn("band", label), "lo").select("band", "lo", "patients", "pct_of_panel")


def filter_panel(scores: DataFrame, tiers: list[str] | None = None, low: int = 0, high: int = 100) -> DataFrame:
    return scores.where(F.col("tier").isin(tiers or TIERS) & F.col("risk_score").between(low, high))


def explorer(view: DataFrame, limit: int = 1000) -> DataFrame:
    return view.select(*EXPORT_COLUMNS).orderBy(F.desc("risk_score"), "patient_id").limit(limit)


def pick_list(view: DataFrame, limit: int = 500, fallback: DataFrame | None = None) -> DataFrame:
    """Highest scores of the filtered view, or of ``fallback`` when the view is empty."""
    if fallback is not None:
        shown = view.agg(F.count("*")).scalar()
        view = view.unionByName(fallback.where(shown == 0), allowMissingColumns=True)
    return view.select("patient_id", "risk_score").orderBy(F.desc("risk_score"), "patient_id").limit(limit)


def patient_card(scores: DataFrame, patient_id: int) -> DataFrame:
    return scores.where(F.col("patient_id") == patient_id)


def headline(scores: DataFrame) -> DataFrame:
    high = F.count_if(F.col("tier") == "High")
    return scores.agg(
        F.count("*").alias("patients"),
        high.alias("high_risk"),
        percent(high, F.count("*")).alias("high_risk_pct"),
        F.round(F.avg("risk_score"), 6).alias("mean_score"),
    )
