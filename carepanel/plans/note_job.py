"""Notes in, one annotated row per note out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carepanel.operators import notes as nt


def spread(notes: DataFrame) -> DataFrame:
    """Notes dealt out evenly: annotating is far costlier than moving the text once, and row groups are uneven.

    The number of partitions is left to adaptive execution, so it follows the data.
    """
    return notes.hint("rebalance")


def annotated_notes(notes: DataFrame, **options) -> DataFrame:
    return nt.annotate(spread(notes), **options)


def write_annotations(notes: DataFrame, root: str, **options) -> None:
    """Store the annotations, then the features and flags read back from them."""
    spark = notes.sparkSession
    annotated_notes(notes, **options).write.mode("overwrite").parquet(f"{root}/annotations")
    stored = spark.read.parquet(f"{root}/annotations")
    nt.note_features(stored).write.mode("overwrite").parquet(f"{root}/note_features")
    nt.readmission_flags(stored).write.mode("overwrite").parquet(f"{root}/note_flags")
