"""Bulk clinical resources: newline-delimited JSON, one resource per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from carepanel.functions.arrays import computed_once
from carepanel.sources.schemas import CORRUPT, RESOURCE_DDL, resource_schema


FEED = "feed"
#: Read blocks (one row each) below which their first numbers are broadcast to the lines.
BROADCAST_BLOCKS = 1_000_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of a feed with ``feed``: their place in the feed, files by name, lines in file order (blank lines
    keep their places, so numbers are unique and ordered but may skip).

    Lines are counted per read block (file and block start); a prefix sum over the blocks in (file name, block start)
    order gives each block its first number, and a line adds its place inside the block. The number does not depend
    on split size, on how blocks are packed into tasks or on the number of executors. Only one row per block reaches
    the window of the prefix sum.
    """
    read = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),  # rises along a task's lines; rows of one block are adjacent
    )
    blocks = read.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = read.join(F.broadcast(starts) if blocks.count() <= BROADCAST_BLOCKS else starts, ["_file", "_block"])
    line = (F.col("_start") + F.col("_at") - F.col("_first")).alias(FEED)
    return numbered.select("value", line).where(F.trim("value") != "")


def read_resources(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Scan an NDJSON export of one resource type with its declared schema.

    Lines are read as text and parsed with the whole schema, so that whether a line is broken does not depend on
    the columns that a later step asks for. Broken ones have ``_corrupt_record`` set; see ``split_corrupt``. ``feed``
    is the line's number in the export (``numbered_lines``).
    """
    return parse_resources(numbered_lines(spark, path), kind, keep=(FEED,))


def parse_resources(lines: DataFrame, kind: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for resources already held as a text column (a queue or a landing table)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column), resource_schema(kind), options)
    return computed_once(lines, parsed, "r").select(*keep, "r.*")


def only_kind(resources: DataFrame, kind: str) -> DataFrame:
    """Resources of the expected type that could be parsed."""
    return resources.where(F.col(CORRUPT).isNull() & (F.col("resourceType") == kind)).drop(CORRUPT)


def split_corrupt(resources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined text): one broken record never stops the rest of the load."""
    good = resources.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = resources.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_record"))
    return good, bad


#: Partial extraction from text that did not parse: the resource type and the patient it names.
RAW_TYPE, RAW_PATIENT = r'"resourceType"\s*:\s*"([^"]*)"', r'"reference"\s*:\s*"Patient/([^"]*)"'


def _failed_field(raw: Column, kind: str) -> Column:
    """The first top-level field of the declared schema whose JSON value does not read as its declared type."""
    checks = []
    for field in T.StructType.fromDDL(RESOURCE_DDL[kind]).fields:
        if isinstance(field.dataType, T.StringType):  # any JSON value reads as text
            continue
        value = F.get_json_object(raw, f"$.{field.name}")  # objects, arrays and numbers as JSON; strings without quotes
        verbatim = value.rlike(r"^\s*[\[{]") | value.rlike(r"^-?[0-9][0-9.eE+-]*$") | value.isin("true", "false")
        wrapped = F.when(verbatim, F.concat(F.lit('{"x":'), value, F.lit("}"))).otherwise(F.to_json(F.struct(value.alias("x"))))
        alone = F.from_json(wrapped, T.StructType([T.StructField("x", field.dataType)]))
        checks.append(F.when(value.isNotNull() & alone["x"].isNull(), F.lit(field.name)))
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def failed_records(resources: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record that the intake cannot use, with ``keep`` columns, the raw text (null when it parsed),
    resource_type and patient (read from the parsed record or, for broken text, extracted from it), reason and path.

    Reasons: ``syntax`` (not a JSON object), ``wrong type`` (JSON whose field ``path`` does not read as declared),
    ``wrong resource`` (parsed, but not a ``kind``).
    """
    raw = F.col(CORRUPT)
    is_json = F.from_json(raw, "map<string,string>").isNotNull()
    broken = resources.where(raw.isNotNull()).select(
        *keep,
        raw.alias("raw_record"),
        F.nullif(F.regexp_extract(raw, RAW_TYPE, 1), F.lit("")).alias("resource_type"),
        F.nullif(F.regexp_extract(raw, RAW_PATIENT, 1), F.lit("")).alias("patient"),
        F.when(is_json, "wrong type").otherwise("syntax").alias("reason"),
        F.when(is_json, _failed_field(raw, kind)).alias("path"),
    )
    subject = F.col("subject.reference")
    foreign = resources.where(raw.isNull() & ~F.coalesce(F.col("resourceType") == kind, F.lit(False))).select(
        *keep,
        F.lit(None).cast("string").alias("raw_record"),
        F.col("resourceType").alias("resource_type"),
        F.when(subject.startswith("Patient/"), F.substring_index(subject, "/", -1)).alias("patient"),
        F.lit("wrong resource").alias("reason"),
        F.lit(None).cast("string").alias("path"),
    )
    return broken.unionByName(foreign)


def set_aside(good: DataFrame, failed: DataFrame, patient: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, aside): the good records of a patient who has a failed record go aside with it, as a failed patient is
    skipped whole; records without a patient stay."""
    failed_patients = failed.where(F.col("patient").isNotNull()).select(F.col("patient").alias("_failed")).distinct()
    marked = good.withColumn("_patient", patient).join(failed_patients, F.col("_patient") == F.col("_failed"), "left")
    kept = marked.where(F.col("_failed").isNull()).drop("_patient", "_failed")
    aside = marked.where(F.col("_failed").isNotNull()).drop("_patient", "_failed")
    return kept, aside
