"""Which features push a patient's risk up or down, for the boosted trees that scored them.

Every fitted tree goes into flat arrays of nodes (feature slot, split, children, mean of the node's training labels).
Inside a task the rows of a batch walk each tree together, a level at a time; each step adds the change of node mean,
times the tree's weight, to the base feature that split. The changes along a path add up to the leaf minus the root, so
the bias (weighted root means) plus all contributions equals the model's margin.
The model's nodes come to the driver once (rounds x 2^depth of them); no row does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.operators import drivers
from carepanel.sources.scratch import ensure_checkpoint_dir


def tree_nodes(spark: SparkSession, boosted) -> dict[str, np.ndarray]:
    """The nodes of all trees as arrays, trees in order, a tree's root first; ``roots`` holds the trees' first places.

    ``left`` and ``right`` are places of children, -1 at leaves; ``goes_left`` has a row per categorical split (``set_of``
    names a node's row, -1 elsewhere) that marks the categories of its left side. They are read from the model as MLlib
    saves it: one table, where asking the JVM for every field of every node takes tens of seconds.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    boosted.write().save(path)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    saved = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["prediction"].alias("mean"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        split["featureIndex"].alias("slot"), split["leftCategoriesOrThreshold"].alias("side"), split["numCategories"].alias("categories"),
    )
    nodes = sorted(saved.collect(), key=lambda r: (r.treeID, r.id))  # the model's nodes, no rows
    roots = np.flatnonzero(np.array([r.id == 0 for r in nodes]))
    first = {nodes[at].treeID: int(at) for at in roots}
    inner = [r.left >= 0 for r in nodes]
    sets = [at for at, r in enumerate(nodes) if inner[at] and r.categories >= 0]
    set_of = np.full(len(nodes), -1)
    set_of[sets] = np.arange(len(sets))
    goes_left = np.zeros((max(1, len(sets)), max((nodes[at].categories for at in sets), default=0) + 1), bool)
    for row, at in enumerate(sets):
        goes_left[row, np.array(nodes[at].side, np.int64)] = True
    return {
        "roots": roots,
        "left": np.array([first[r.treeID] + r.left if i else -1 for r, i in zip(nodes, inner)], np.int64),
        "right": np.array([first[r.treeID] + r.right if i else -1 for r, i in zip(nodes, inner)], np.int64),
        "slot": np.array([r.slot for r in nodes], np.int64),
        "threshold": np.array([r.side[0] if i and r.categories < 0 else 0.0 for r, i in zip(nodes, inner)], np.float64),
        "mean": np.array([r.mean for r in nodes], np.float64),
        "set_of": set_of,
        "goes_left": goes_left,
    }


def _walker(nodes: dict[str, np.ndarray], weights: list[float], base_of: np.ndarray, n_bases: int) -> Callable[[pa.Array], pa.Array]:
    """A function of vectors (lists of doubles) that gives each one its contributions per base feature."""
    left, right, slot, threshold, mean, set_of, goes_left = (
        nodes[k] for k in ("left", "right", "slot", "threshold", "mean", "set_of", "goes_left")
    )
    trees = list(zip(nodes["roots"].tolist(), weights, strict=True))
    width = len(base_of)

    def walk(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        total = np.zeros((len(x), n_bases))
        everyone = np.arange(len(x))
        for root, weight in trees:
            row, at = everyone, np.full(len(x), root)
            while True:
                inner = left[at] >= 0
                if not inner.all():
                    row, at = row[inner], at[inner]
                if not len(row):
                    break
                value = x[row, slot[at]]
                lefts = value <= threshold[at]
                sets = set_of[at]
                listed = np.flatnonzero(sets >= 0)
                if len(listed):
                    category = value[listed]
                    known = (category >= 0) & (category < goes_left.shape[1]) & (category == np.floor(category))
                    lefts[listed] = known & goes_left[sets[listed], np.where(known, category, 0).astype(np.int64)]
                child = np.where(lefts, left[at], right[at])
                total[row, base_of[slot[at]]] += (mean[child] - mean[at]) * weight
                at = child
        ends = np.arange(0, total.size + 1, n_bases, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel()))

    return walk


def slot_features(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """The base feature of every slot of the assembled vector: numbers first, then each category's indicator slots."""
    indexer = next(s for s in model.stages if "StringIndexer" in type(s).__name__)
    slots = list(numeric)
    for column, labels in zip(categorical, indexer.labelsArray):
        slots += [column] * len(labels)
    return slots


def with_tree_contributions(model: PipelineModel, rows: DataFrame, numeric: list[str], categorical: list[str], features_col: str = "features") -> DataFrame:
    """``rows`` scored by the pipeline, with ``bias`` (double), ``margin`` (the model's own) and ``contributions``:
    one struct (feature, value, phrase, patient_value) per base feature, in the order of ``slot_features``, as the
    linear explanations give them (so ``drivers.top_factors`` reads both)."""
    boosted = model.stages[-1]
    slots = slot_features(model, numeric, categorical)
    width = boosted.numFeatures
    if len(slots) != width:
        raise ValueError(f"the pipeline's slots ({len(slots)}) do not cover the model's {width} features")
    bases = list(dict.fromkeys(slots))
    weights = [float(w) for w in boosted.treeWeights]
    nodes = tree_nodes(rows.sparkSession, boosted)
    bias = sum(w * m for w, m in zip(weights, nodes["mean"][nodes["roots"]].tolist(), strict=True))
    walk = _walker(nodes, weights, np.array([bases.index(s) for s in slots]), len(bases))

    @F.arrow_udf("array<double>")
    def values(vectors: pa.Array) -> pa.Array:
        return walk(vectors)

    walked = model.transform(rows).withColumn("_values", values(vector_to_array(features_col)))
    per_base = [
        F.struct(
            F.lit(b).alias("feature"),
            F.get("_values", F.lit(i)).alias("value"),
            drivers.readable_factor(b).alias("phrase"),
            drivers.readable_value(b).alias("patient_value"),
        )
        for i, b in enumerate(bases)
    ]
    return walked.withColumns(
        {"bias": F.lit(bias), "margin": vector_to_array("rawPrediction")[1], "contributions": F.array(*per_base)}
    ).drop("_values")
