"""Care gaps per patient and the daily outreach worklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.arrays import computed_once, to_rows
from carepanel.functions.numeric import sure_flag
from carepanel.operators.measures import MEDICARE
from carepanel.operators.panel_risk import ADHERENT_PDC, YEAR

# Gap priorities, most urgent first.
PRIORITIES = ["CRITICAL", "HIGH", "MODERATE", "LOW"]
PRIORITY_RANK = {p: i for i, p in enumerate(PRIORITIES)}

GAP_ATTRIBUTES = [
    "patient_token", "age", "risk_tier", "risk_score", "num_conditions", "has_diabetes", "has_hypertension",
    "contact_preference", "mychart_enrolled",
]
WORKLIST_COLUMNS = [
    "outreach_priority", "patient_token", "age", "risk_tier", "risk_score", "highest_priority_label", "num_gaps",
    "gap_types", "top_action", "suggested_channel", "num_conditions", "has_diabetes", "has_hypertension",
    "last_pcp_visit_days",
]
EXPLORER_COLUMNS = [
    "patient_token", "age", "risk_tier", "risk_score", "gap_type", "priority", "description", "recommended_action",
]


def _text(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def _as_text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def gap_rules() -> list[tuple[Column, str, Column, Column, str, Column]]:
    """(applies, type, description, priority, action, overdue days) in reporting order.

    Types, texts and priorities are fixed values.
    """
    c = F.col
    diabetic, hypertensive = c("has_diabetes") == 1, c("has_hypertension") == 1
    severe = (c("systolic_bp") >= 160) | (c("diastolic_bp") >= 100)
    raised = (c("systolic_bp") >= 140) | (c("diastolic_bp") >= 90)
    lost = c("last_pcp_visit_days") > YEAR
    none = F.lit(0)
    critical, high, moderate = (F.lit(p) for p in PRIORITIES[:3])
    bp = F.concat(_as_text("systolic_bp"), F.lit("/"), _as_text("diastolic_bp"))

    def pdc(col: str) -> Column:
        return _text("%.0f%%", c(col) * 100)

    return [
        (diabetic & (c("days_since_hba1c") > YEAR), "HbA1c_Overdue",
         F.lit("HbA1c test overdue (>12 months)"), high,
         "Order HbA1c lab — can be standing order or during next visit", c("days_since_hba1c") - YEAR),
        (diabetic & (c("hba1c") > 9.0) & (c("days_since_hba1c") <= YEAR), "Uncontrolled_Diabetes",
         F.concat(F.lit("Poor glycemic control — HbA1c "), _as_text("hba1c"), F.lit("%")), critical,
         "Urgent care manager outreach — medication review and endocrinology referral", none),
        (diabetic & (c("diabetes_med_pdc") < ADHERENT_PDC), "DM_Med_Adherence",
         F.concat(F.lit("Diabetes medication non-adherence — PDC "), pdc("diabetes_med_pdc")), high,
         "Pharmacy outreach — barrier assessment, pill pack consideration", none),
        (hypertensive & severe, "Uncontrolled_HTN_Severe",
         F.concat(F.lit("Severe uncontrolled BP: "), bp), critical,
         "Same-day nurse callback — check if patient symptomatic, urgent PCP appointment", none),
        (hypertensive & raised & ~severe, "Uncontrolled_HTN",
         F.concat(F.lit("Uncontrolled BP: "), bp), high,
         "Schedule follow-up visit for medication adjustment", none),
        (hypertensive & (c("htn_med_pdc") < ADHERENT_PDC), "HTN_Med_Adherence",
         F.concat(F.lit("Hypertension medication non-adherence — PDC "), pdc("htn_med_pdc")), high,
         "Pharmacy outreach — cost barrier assessment, generic alternatives", none),
        (c("statin_gap") == 1, "Statin_Gap",
         F.lit("Statin not prescribed — eligible patient (CAD or diabetes age 40+)"), high,
         "PCP notification — add statin to medication regimen at next visit", none),
        (c("colonoscopy_due") == 1, "Colorectal_Screening",
         F.lit("Colorectal cancer screening overdue"), moderate,
         "Schedule colonoscopy or offer FIT test alternative", none),
        (c("mammogram_due") == 1, "Mammogram_Screening",
         F.lit("Mammogram overdue"), moderate,
         "Schedule mammogram — can offer mobile mammography if transportation barrier", none),
        (c("insurance").isin(MEDICARE) & (c("awv_completed") == 0), "Annual_Wellness_Visit",
         F.lit("Annual Wellness Visit not completed this year"), moderate,
         "Outreach to schedule AWV — covered at no cost to patient", none),
        (lost, "Lost_to_Followup",
         F.concat(F.lit("No PCP visit in "), _as_text("last_pcp_visit_days"), F.lit(" days")),
         F.when(c("num_conditions") >= 2, high).otherwise(moderate),
         "Reconnection outreach — identify barriers, offer telehealth", c("last_pcp_visit_days") - YEAR),
        (c("sdoh_risk_score") >= 2, "SDOH_High_Risk",
         F.concat(F.lit("High SDOH risk score: "), _as_text("sdoh_risk_score"), F.lit("/4")), moderate,
         "Social work referral — address transportation, food, housing barriers", none),
    ]


def priority_rank(priority: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in PRIORITY_RANK.items() for x in pair])
    return F.try_element_at(ranks, priority)


def gap_array() -> Column:
    """The open gaps of a panel row (at most one per rule) as an array of structs."""
    items = []
    for order, (applies, kind, description, priority, action, days) in enumerate(gap_rules()):
        gap = F.struct(
            priority_rank(priority).alias("priority_rank"),
            F.lit(order).alias("gap_order"),
            F.lit(kind).alias("gap_type"),
            description.alias("description"),
            priority.alias("priority"),
            F.lit(action).alias("recommended_action"),
            days.cast("int").alias("gap_days"),
        )
        items.append(F.when(applies, gap))
    return F.filter(F.array(*items), lambda g: g.isNotNull())


def gap_count() -> Column:
    """Number of open gaps of a panel row, without building their texts."""
    return sum((sure_flag(rule[0]) for rule in gap_rules()), F.lit(0))


def gap_count_of(priority: str) -> Column:
    """Number of open gaps of one priority, without building their texts."""
    rules = gap_rules()
    return sum((sure_flag(applies & (level == priority)) for applies, _, _, level, _, _ in rules), F.lit(0))


def care_gaps(panel: DataFrame) -> DataFrame:
    """One row per patient and open gap, with the attributes outreach needs. No shuffle."""
    return to_rows(panel, gap_array(), *GAP_ATTRIBUTES, alias="gap").select(*GAP_ATTRIBUTES, "gap.*")


def in_urgency_order(gaps: DataFrame) -> DataFrame:
    return gaps.orderBy("priority_rank", F.desc("risk_score"), "patient_token", "gap_order")


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Per-patient summary of a stored gap table: at most one row per rule and patient to group."""
    return gaps.groupBy("patient_token").agg(
        F.count("*").cast("int").alias("num_gaps"),
        F.min("priority_rank").alias("highest_priority"),
        F.array_join(F.array_sort(F.collect_set("gap_type")), ", ").alias("gap_types"),
        F.min_by("recommended_action", F.struct("priority_rank", "gap_order")).alias("top_action"),
    )


def with_gap_summary(panel: DataFrame) -> DataFrame:
    """The same summary straight from the panel row: no explode, no grouping, no join.

    All gaps of a patient come from that patient's own row, so the summary is a narrow expression.
    """
    gaps = F.col("_gaps")
    ranked = F.array_sort(F.transform(gaps, lambda g: F.struct(g["priority_rank"], g["gap_order"], g["recommended_action"])))
    return (
        computed_once(panel, gap_array(), "_gaps")
        .where(F.size(gaps) > 0)
        .withColumn("num_gaps", F.size(gaps))
        .withColumn("highest_priority", F.array_min(F.transform(gaps, lambda g: g["priority_rank"])))
        .withColumn("gap_types", F.array_join(F.array_sort(F.transform(gaps, lambda g: g["gap_type"])), ", "))
        .withColumn("top_action", F.get(ranked, F.lit(0))["recommended_action"])
        .drop("_gaps")
    )


def outreach_channel() -> Column:
    # Channel texts.
    return (
        F.when(F.col("highest_priority_label") == "CRITICAL", "PHONE — Same day")
        .when(F.col("mychart_enrolled") == 1, "MyChart message")
        .when(F.col("contact_preference") == "Text", "Text message")
        .otherwise("Phone call")
    )


def worklist(summarised: DataFrame, capacity: int = 30) -> DataFrame:
    """The ``capacity`` most urgent patients, numbered. Input: panel rows with their gap summary.

    Sort and limit become one top-k per task; only the final rows are numbered.
    """
    keys = [F.asc("highest_priority"), F.desc("risk_score"), F.desc("num_gaps"), F.asc("patient_token")]
    labels = F.array(*[F.lit(p) for p in PRIORITIES])
    top = summarised.withColumn("highest_priority_label", F.get(labels, F.col("highest_priority")))
    top = top.withColumn("suggested_channel", outreach_channel()).orderBy(*keys).limit(capacity)
    numbered = top.withColumn("outreach_priority", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*keys)))
    return numbered.select(*WORKLIST_COLUMNS)


def daily_worklist(panel: DataFrame, capacity: int = 30) -> DataFrame:
    return worklist(with_gap_summary(panel), capacity)


def worklist_from_gaps(panel: DataFrame, gaps: DataFrame, capacity: int = 30) -> DataFrame:
    """The worklist when gaps were written by an earlier job."""
    return worklist(panel.join(gap_summary(gaps), "patient_token"), capacity)


def explore_gaps(gaps: DataFrame, priorities: list[str] | None = None, limit: int = 500) -> DataFrame:
    """First rows of the gap explorer for the chosen priorities; no choice means all."""
    if priorities:
        gaps = gaps.where(F.col("priority").isin(priorities))
    return in_urgency_order(gaps).select(*EXPLORER_COLUMNS).limit(limit)
