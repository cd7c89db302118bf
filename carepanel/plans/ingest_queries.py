"""Queries over CSV text made from the admissions table: a header in another order, an extra column whose quoted
fields hold newlines, and one short row; read back by the source contract (SURVEY D01, D03)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.sources.encounters import read_csv_by_header
from carepanel.sources.fixture_views import view
from carepanel.sources.schemas import ENCOUNTER_REQUIRED
from carepanel.sources.scratch import ensure_checkpoint_dir


def _written(spark: SparkSession, d: str) -> tuple[str, list[str]]:
    admissions = view(spark, d, "admissions")
    columns = admissions.columns
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    note = F.concat_ws("\n", F.col("race"), F.lit("said: \"see\", ok"), F.col("gender")).alias("note")
    text = admissions.select(note, *[F.col(c).cast("string").alias(c) for c in reversed(columns)])
    text.write.options(header=True, escape='"').csv(f"{root}/admissions")
    header = ",".join(["note", *reversed(columns)])
    short = admissions.agg(F.min("encounter_id").cast("string").alias("id")).select(F.concat(F.lit(header + "\n\"x\n y\","), "id").alias("value"))
    short.write.text(f"{root}/admissions_late")
    return root, columns


def csv_contract(spark: SparkSession, d: str) -> DataFrame:
    """D01, D03: every admission read back as text in the contract's columns, whatever the order of the header."""
    root, columns = _written(spark, d)
    rows, _ = read_csv_by_header(spark, f"{root}/admissions*", ENCOUNTER_REQUIRED)
    return rows.select(*columns)


def csv_broken_rows(spark: SparkSession, d: str) -> DataFrame:
    """D01: the good and the broken rows of the same text with the short row added."""
    root, _ = _written(spark, d)
    rows, broken = read_csv_by_header(spark, f"{root}/admissions*", ENCOUNTER_REQUIRED)
    marked = rows.select(F.lit(1).alias("good"), F.lit(0).alias("bad")).unionByName(broken.select(F.lit(0).alias("good"), F.lit(1).alias("bad")))
    return marked.agg(F.sum("good").cast("long").alias("rows"), F.sum("bad").cast("long").alias("broken"))


QUERIES = {
    "d01_d03_csv_contract": csv_contract,
    "d01_csv_broken_rows": csv_broken_rows,
}
