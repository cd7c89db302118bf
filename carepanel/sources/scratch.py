"""Cutting lineage before iterative work."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, from ``spark.checkpoint.dir`` or as already set on the context.

    Local mode, where driver and executors are one process, may do without: it gets a folder of its own. Anywhere
    else a missing setting is an error, as executors would write to disks that nobody else reads.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back.

    Model fitting scans its input many times. A checkpoint is computed once, outlives lost executors
    and needs no recomputation of the cleaning shuffles.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled_columns(df: DataFrame) -> DataFrame:
    """As ``settled``, as Parquet: for rows of plain columns that many passes read, each a few of the columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever they run (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="code-")) / f"{PACKAGE.name}_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, f"{PACKAGE.name}/{source.relative_to(PACKAGE)}")
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
