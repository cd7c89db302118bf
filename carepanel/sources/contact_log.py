"""The contact log: a small mutable table kept as immutable versions, safe under several writers.

Parquet cannot be overwritten while it is read, so each upsert writes the next version directory. Writers use
optimistic concurrency on the shared file system: a writer reads the newest committed version N, merges its upsert
into it, claims version N + 1 by creating ``_claims/vN+1`` without overwrite (atomic on HDFS, object-store
connectors with conditional create, and local disks), writes the data and then decides the version by creating
``_decided/vN+1`` holding one byte, committed. A writer that loses a claim reads the newer version and merges again.
A claim left undecided longer than ``patience`` seconds (its writer died: a torn claim) is decided abandoned by the
next writer, by the same exclusive create, so a late writer of it can no longer commit; readers take committed
versions only.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.sources.sinks import create_exclusive, list_names, read_file

SCHEMA = "patient_id BIGINT, last_contacted DATE"


def usable_contacts(raw: DataFrame) -> DataFrame:
    """Typed log; rows without a readable date are dropped."""
    typed = raw.select(
        F.col("patient_id").cast("string").try_cast("bigint").alias("patient_id"),
        F.try_to_date(F.col("last_contacted").cast("string"), "yyyy-MM-dd").alias("last_contacted"),
    )
    return typed.where(F.col("last_contacted").isNotNull())


def upsert_contacts(log: DataFrame, patient_ids: DataFrame, when: str) -> DataFrame:
    """The log after contacting the given patients: their earlier rows are replaced."""
    new = patient_ids.select(F.col("patient_id").cast("bigint")).distinct()
    kept = log.join(new, "patient_id", "left_anti")
    return kept.unionByName(new.withColumn("last_contacted", F.lit(when).cast("date")))


CLAIMS, DECIDED = "_claims", "_decided"
COMMITTED, ABANDONED = ord("c"), ord("a")


def _create_new(spark: SparkSession, path: str, mark: int | None = None) -> bool:
    return create_exclusive(spark, path, b"" if mark is None else bytes([mark]))


def _decision(spark: SparkSession, root: str, version: int) -> int | None:
    data = read_file(spark, f"{root}/{DECIDED}/v{version:06d}")
    return data[0] if data else None


def _numbers(spark: SparkSession, folder: str) -> set[int]:
    return {int(n[1:]) for n in list_names(spark, folder) if re.fullmatch(r"v\d+", n)}


def newest_committed(spark: SparkSession, root: str) -> int:
    """The highest committed version, 0 when there is none."""
    for version in sorted(_numbers(spark, f"{root}/{DECIDED}"), reverse=True):
        if _decision(spark, root, version) == COMMITTED:
            return version
    return 0


def read_contact_log(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest committed version (or the given one), or an empty log; claimed, torn and abandoned ones are never read."""
    version = newest_committed(spark, root) if version is None else version
    if not version:
        return spark.createDataFrame([], SCHEMA)
    return usable_contacts(spark.read.schema(SCHEMA).parquet(f"{root}/v{version:06d}"))


def save_contacts(spark: SparkSession, root: str, patient_ids: DataFrame, when: str, patience: float = 600.0, attempts: int = 50) -> str:
    """Upsert the contacted patients as the next committed version and return its folder.

    The merge is always made against the version right before the claimed one (skipping abandoned claims), so two
    writers that start from one version both survive: the loser of the claim merges again onto the winner's rows.
    """
    for _ in range(attempts):
        base = newest_committed(spark, root)
        claimed = _numbers(spark, f"{root}/{CLAIMS}")
        version, busy = base + 1, None
        while version in claimed:
            decided = _decision(spark, root, version)
            if decided == ABANDONED:
                version += 1
                continue
            busy = version if decided is None else None
            break
        if busy is not None:  # another writer holds the successor: wait for it, then give it up as torn
            deadline = time.monotonic() + patience
            while _decision(spark, root, busy) is None and time.monotonic() < deadline:
                time.sleep(0.2)
            _create_new(spark, f"{root}/{DECIDED}/v{busy:06d}", ABANDONED)
            continue
        if version in claimed or not _create_new(spark, f"{root}/{CLAIMS}/v{version:06d}"):
            continue
        target = f"{root}/v{version:06d}"
        merged = upsert_contacts(read_contact_log(spark, root, base), patient_ids, when)
        merged.sort("patient_id").write.mode("errorifexists").parquet(target)
        if _create_new(spark, f"{root}/{DECIDED}/v{version:06d}", COMMITTED):
            return target
    raise RuntimeError(f"no version of {root} could be committed after {attempts} attempts")
