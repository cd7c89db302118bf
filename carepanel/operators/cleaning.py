"""Cleaning of raw hospital encounters down to one usable row per patient."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T
from pyspark.sql.window import Window

from carepanel.functions.numeric import rounded, sure_flag
from carepanel.functions.quantiles import exact_quantiles

# Missing tokens, dropped columns, discharge codes of expired or hospice patients.
MISSING_TOKENS = ["?", ""]
SPARSE_COLUMNS = ["weight", "payer_code"]
EXPIRED_OR_HOSPICE = [11, 13, 14, 19, 20, 21]
CAPPED_COLUMNS = ["time_in_hospital", "num_medications", "number_outpatient", "number_emergency", "number_inpatient"]
CAP_QUANTILE = 0.99

AGE_RANGE = r"^[\[\]()]*(\d+)-(\d+)[\[\]()]*$"

PATIENT, ENCOUNTER, TARGET = "patient_nbr", "encounter_id", "readmit_30d"


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def missing_to_null(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~_name(c).isin(MISSING_TOKENS), _name(c)) for c in texts})


def drop_sparse(df: DataFrame) -> DataFrame:
    return df.drop(*SPARSE_COLUMNS)


def survivable(df: DataFrame) -> Column:
    """False only for a known expired or hospice discharge; an unknown code stays in."""
    if "discharge_disposition_id" not in df.columns:
        return F.lit(True)
    return ~F.coalesce(F.col("discharge_disposition_id").isin(EXPIRED_OR_HOSPICE), F.lit(False))


def exclude_expired(df: DataFrame) -> DataFrame:
    return df.where(survivable(df))


def first_encounters(df: DataFrame) -> DataFrame:
    """First encounter per patient. The group limit runs before the shuffle, so frequent patients are cheap."""
    earliest = Window.partitionBy(PATIENT).orderBy(F.col(ENCOUNTER).asc_nulls_last())
    return df.withColumn("_n", F.row_number().over(earliest)).where(F.col("_n") == 1).drop("_n")


def cap_outliers(df: DataFrame, quantile: float = CAP_QUANTILE) -> DataFrame:
    """Cap skewed counts at an exact quantile, found by distributed selection over counts per value (no task holds
    all distinct values); the caps reach the rows as literals. A column without values is left as it is.
    """
    present = [c for c in CAPPED_COLUMNS if c in df.columns]
    if not present:
        return df
    caps = {c: v[0] for c, v in exact_quantiles(df, present, [quantile]).items()}
    capped = {c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.lit(caps[c]).cast("double"))) for c in present}
    return df.withColumns(capped)


def age_midpoint(age: Column) -> Column:
    """``[70-80)`` to 75.0; null for text without a range."""
    edge = lambda g: F.regexp_extract(age, AGE_RANGE, g).try_cast("double")
    return (edge(1) + edge(2)) / 2.0


def standardize(df: DataFrame) -> DataFrame:
    added = {}
    if "age" in df.columns:
        added["age_midpoint"] = age_midpoint(F.col("age"))
    if "change" in df.columns:
        added["change_flag"] = sure_flag(F.col("change") == "Ch")
    if "diabetesMed" in df.columns:
        added["diabetes_med_flag"] = sure_flag(F.col("diabetesMed") == "Yes")
    return df.withColumns(added) if added else df


def add_target(df: DataFrame) -> DataFrame:
    return df.withColumn(TARGET, sure_flag(F.col("readmitted") == "<30"))


def usable_first_encounters(raw: DataFrame) -> DataFrame:
    """The row-dropping half of the cleaning, ending in the one shuffle by patient."""
    return reduce(lambda df, step: step(df), [missing_to_null, drop_sparse, exclude_expired, first_encounters], raw)


def finish(first: DataFrame) -> DataFrame:
    """The value half: caps, standard fields and target."""
    return reduce(lambda df, step: step(df), [cap_outliers, standardize, add_target], first)


def clean(raw: DataFrame) -> DataFrame:
    """Both halves. The deduplicated rows are kept (spilling to disk), as caps and levels are aggregates over them."""
    return finish(usable_first_encounters(raw).persist())


def provenance(raw: DataFrame) -> DataFrame:
    """Rows left after each step and the share of readmissions, from one aggregation by patient."""
    keep = survivable(raw)
    target = sure_flag(F.col("readmitted") == "<30")
    per_patient = raw.groupBy(PATIENT).agg(
        F.count("*").alias("rows"),
        F.count_if(keep).alias("kept"),
        F.min_by(target, F.when(keep, F.col(ENCOUNTER))).alias("first_target"),
    )
    has_kept = F.col("kept") > 0
    return per_patient.agg(
        F.sum("rows").alias("rows_raw"),
        F.sum("kept").alias("rows_after_exclusions"),
        F.count_if(has_kept).alias("rows_after_dedup"),
        F.count_if(has_kept).alias("rows_final"),
        rounded(F.avg(F.when(has_kept, F.col("first_target"))), 4).alias("positive_rate"),
    )
