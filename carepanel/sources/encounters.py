"""Raw hospital encounters: text first, then typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepanel.functions.numeric import plain_number, whole_number
from carepanel.sources.schemas import ENCOUNTER_IDS, ENCOUNTER_NUMBERS, ENCOUNTER_REQUIRED
from carepanel.sources.scratch import settled


def read_encounter_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV scan with every column as text; nothing is inferred from the data."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


CORRUPT = "_corrupt_record"
# Text of a CSV file: an unquoted empty field is null (handed over as the sentinel), a quoted one the empty text.
READ_TEXT = {"header": True, "multiLine": True, "escape": '"', "nullValue": "\u0000", "emptyValue": "", "mode": "PERMISSIVE"}


def read_csv_by_header(spark: SparkSession, path: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """A CSV source read by its own header: (rows, broken).

    Columns are named by the file's first line, in any order, all as text; extra columns stay. Quoted fields may hold
    newlines. A row whose number of fields differs from the header's goes to ``broken`` (its raw text in ``record``)
    instead of being read into the wrong columns. A header without a required column is an error.
    """
    header = spark.read.options(header=True, multiLine=True, escape='"').csv(path).columns
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"the source's header lacks columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(schema).options(**READ_TEXT, columnNameOfCorruptRecord=CORRUPT, enforceSchema=False).csv(path)
    # parsed once into the shared checkpoint folder: both parts read it, and Spark reads no corrupt column from raw text alone
    flagged = settled(raw.withColumn("_broken", F.col(CORRUPT).isNotNull()))
    rows = flagged.where(~F.col("_broken")).drop(CORRUPT, "_broken")
    broken = flagged.where(F.col("_broken")).select(F.col(CORRUPT).alias("record"))
    return rows, broken


def coerce_numbers(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Ids of the raw file as bigint, its other number columns as doubles; text that is no number becomes null."""
    present = [c for c in (ENCOUNTER_NUMBERS if columns is None else columns) if c in raw.columns]
    if not present:
        return raw
    read = lambda c: whole_number if c in ENCOUNTER_IDS else plain_number
    return raw.withColumns({c: read(c)(F.col(f"`{c}`")) for c in present})


def load_encounters(
    spark: SparkSession, path: str, loader: Callable[[SparkSession, str], DataFrame], required: list[str] | None = None
) -> DataFrame:
    """Any loader will do, as long as its table has the raw columns the cleaning needs."""
    raw = loader(spark, path)
    missing = [c for c in required or ENCOUNTER_REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"encounter source lacks columns: {missing}")
    return coerce_numbers(raw)
