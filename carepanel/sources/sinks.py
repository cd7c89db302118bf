"""Output layouts: versioned snapshots, table sets and the JSON summary."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepanel.operators.panel_risk import RISK_TIERS
from carepanel.sources.scratch import settled

LATEST = "LATEST"
PUBLISHED, RUNS, CLAIMS = "_published", "_runs", "_claims"
# Quotes are doubled, white space stays, and an empty text is written as "" while null is nothing.
CSV = {"header": True, "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Read back: an unquoted empty field is null (the parser hands it over as the sentinel), a quoted one is the empty text.
READ_CSV = {"header": True, "multiLine": True, "escape": '"', "nullValue": "\u0000", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    target = _hadoop_path(spark, path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a path on whatever file system holds it."""
    root, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def create_exclusive(spark: SparkSession, path: str, data: bytes = b"") -> bool:
    """Create a small file only if it does not exist yet (atomic on HDFS, local disks and object stores with
    conditional create); False when another writer has it."""
    target, fs = _file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Exception as error:  # the JVM's FileAlreadyExistsException (or an IOException on some file systems)
        if fs.exists(target):
            return False
        raise error
    try:
        if data:
            out.write(bytearray(data))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> bytes | None:
    """A small file's bytes, or None when it does not exist."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    return sorted(int(m.group(1)) for m in (re.fullmatch(rf"{prefix}(\d+)(?:\.json)?", n) for n in list_names(spark, folder)) if m)


def next_version(spark: SparkSession, root: str, prefix: str = "v") -> int:
    return max(_numbers(spark, root, prefix), default=0) + 1


def publish(spark: SparkSession, root: str, manifest: dict) -> int:
    """Publish a manifest as the next number under ``_published`` by an exclusive create; returns its number.

    Readers follow the highest manifest, so a run is visible whole or not at all."""
    while True:
        number = max(_numbers(spark, f"{root}/{PUBLISHED}", "m"), default=0) + 1
        if create_exclusive(spark, f"{root}/{PUBLISHED}/m{number:06d}.json", json.dumps({**manifest, "number": number}).encode()):
            return number


def latest_manifest(spark: SparkSession, root: str) -> dict | None:
    numbers = _numbers(spark, f"{root}/{PUBLISHED}", "m")
    return json.loads(read_file(spark, f"{root}/{PUBLISHED}/m{numbers[-1]:06d}.json")) if numbers else None


def _entry(df: DataFrame, path: str, fmt: str) -> dict:
    return {"path": path, "format": fmt, "schema": df.schema.json()}


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("errorifexists")
    (writer.options(**CSV).csv if fmt == "csv" else writer.parquet)(path)


def read_entry(spark: SparkSession, entry: dict) -> DataFrame:
    reader = spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"])))
    return reader.options(**READ_CSV).csv(entry["path"]) if entry["format"] == "csv" else reader.parquet(entry["path"])


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest published run of ``root``, with the schema it was written with."""
    manifest = latest_manifest(spark, root)
    if manifest is None or name not in manifest["tables"]:
        raise KeyError(f"{name} is not published under {root}")
    return read_entry(spark, manifest["tables"][name])


def write_versioned(df: DataFrame, root: str) -> str:
    """Write snapshot ``v###`` (claimed by an exclusive create, never overwritten) and point LATEST at it.

    LATEST is the newest manifest under ``_published``, never a folder written over; ``read_latest`` follows it.
    """
    spark = df.sparkSession
    rows = settled(df)
    while True:
        version = max(_numbers(spark, root, "v") + _numbers(spark, f"{root}/{CLAIMS}", "v"), default=0) + 1
        if create_exclusive(spark, f"{root}/{CLAIMS}/v{version:03d}"):
            break
    target = f"{root}/v{version:03d}"
    _write(rows, target, "csv")
    publish(spark, root, {"pointer": LATEST, "version": version, "tables": {"snapshot": _entry(rows, target, "csv")}})
    return target


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, root, "snapshot")


def write_tables(tables: dict[str, DataFrame], root: str, fmt: str = "csv", skip_empty: bool = False) -> list[str]:
    """Write all tables of one run under a fresh staging folder, then publish one manifest naming them.

    Until the manifest is published, readers (``read_published``) see the previous run whole, so a failure between
    two tables leaves the old set readable. With ``skip_empty`` tables without rows are left out of the manifest
    (what was written tells; the query does not run twice). Returns the names published.
    """
    spark = next(iter(tables.values())).sparkSession if tables else None
    run = f"{root}/{RUNS}/{uuid.uuid4().hex}"
    entries = {}
    for name, df in tables.items():
        path = f"{run}/{name}"
        _write(df, path, fmt)
        entry = _entry(df, path, fmt)
        if skip_empty and read_entry(spark, entry).isEmpty():
            _delete(spark, path)
            continue
        entries[name] = entry
    if spark is not None:
        publish(spark, root, {"run": run, "tables": entries})
    return list(entries)


def _delete(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def population_snapshot(panel: DataFrame, gap_totals: DataFrame, measure_table: DataFrame, generated_at: str) -> DataFrame:
    """One nested row: panel size, tier counts, gap totals and the ten measure records."""
    tiers = [x for t in RISK_TIERS for x in (F.lit(t), F.count_if(F.col("risk_tier") == t))]
    counted = panel.agg(F.struct(F.count("*").alias("size"), F.create_map(*tiers).alias("tiers"))).scalar()
    records = measure_table.agg(F.collect_list(F.struct(*measure_table.columns))).scalar()
    return gap_totals.select(
        F.lit(generated_at).alias("generated_at"),
        counted["size"].alias("population_size"),
        counted["tiers"].alias("risk_tier_counts"),
        F.col("total_gaps").alias("total_care_gaps"),
        "patients_with_gaps",
        records.alias("hedis_measures"),
    )


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    snapshot.write.mode("overwrite").json(path)
