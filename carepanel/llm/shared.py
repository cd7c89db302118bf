"""What the operators of this package share: the shared folder, stored tables, code for the Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", 1000
_private: list[str] = []
_tables: dict[str, Callable[[], None]] = {}
_shipped: set[str] = set()


def hold_table(owner: str, clear: Callable[[], None]) -> None:
    """Let a Python worker, which serves many stages, keep the token table of one operator at a time."""
    for other in [o for o in _tables if o != owner]:
        _tables.pop(other)()
    _tables[owner] = clear


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a private folder stands in for it in local mode (tests); on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _private:
        _private.append(tempfile.mkdtemp(prefix="shared-"))
    return _private[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder as Parquet and read back.

    It cuts the lineage, so a lost executor costs no recomputation of what led to the rows, and several later
    steps can read them without computing them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this session this package, wherever they run (once per application).

    Rows are whole texts, so batches to and from Python hold BATCH_ROWS of them unless the session has its own number.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, f"{PACKAGE.name}/{source.relative_to(PACKAGE)}")
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
