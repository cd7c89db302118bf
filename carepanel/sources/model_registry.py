"""Versioned model store: each version holds a fitted pipeline and the fingerprint of the feature schema it was
fitted on; loading for scoring checks the rows' schema against it before any row is scored.

Versions are claimed by an exclusive create and published by a manifest (as the table sinks are), so two runs never
write one version and readers never see a half-written one.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from carepanel.sources.sinks import CLAIMS, _numbers, create_exclusive, latest_manifest, publish


def schema_fingerprint(df: DataFrame, columns: list[str]) -> str:
    """SHA-256 of the names and types of the columns a model reads, in their order; a missing column is an error."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [c for c in columns if c not in types]
    if missing:
        raise ValueError(f"the rows lack columns the model reads: {missing}")
    return hashlib.sha256(json.dumps([[c, types[c]] for c in columns]).encode()).hexdigest()


def register(model: PipelineModel, features: DataFrame, columns: list[str], root: str, name: str) -> int:
    """Store ``model`` as the next version of ``name`` with the fingerprint of ``features``; returns the version."""
    spark = features.sparkSession
    home = f"{root}/{name}"
    while True:
        version = max(_numbers(spark, f"{home}/{CLAIMS}", "v"), default=0) + 1
        if create_exclusive(spark, f"{home}/{CLAIMS}/v{version:04d}"):
            break
    path = f"{home}/v{version:04d}"
    model.write().save(path)
    publish(spark, home, {"version": version, "model": path, "columns": columns, "fingerprint": schema_fingerprint(features, columns), "tables": {}})
    return version


def load_for(spark: SparkSession, rows: DataFrame, root: str, name: str) -> PipelineModel:
    """The newest published version of ``name``, after checking that ``rows`` have the schema it was fitted on."""
    manifest = latest_manifest(spark, f"{root}/{name}")
    if manifest is None:
        raise KeyError(f"no model {name} under {root}")
    found = schema_fingerprint(rows, manifest["columns"])
    if found != manifest["fingerprint"]:
        raise ValueError(f"the rows' schema differs from the one model {name} v{manifest['version']} was fitted on")
    return PipelineModel.load(manifest["model"])
