"""Boosted trees of several training sets (the folds of a run) fitted in lockstep, as MLlib's GBTClassifier fits one.

MLlib starts a job per tree level and set, and each reads every one-hot slot of every row. Here one job serves a level of
all sets: rows are binned once, their columns packed into a few joint codes (a code names the bins of several columns at
once), and a task sums weights and weighted residuals per code with numpy before the sums are split up by column. Only
those sums, one number per bin and node, come to the driver, which picks the splits.

The algorithm is MLlib's: logistic loss on labels -1 and 1, the first tree on the labels themselves, later ones on the
negative gradient; variance gain; thresholds between weighted values; one-hot slots as categories of their own; a share of
the rows per tree and of the slots per node; leaves hold the weighted mean. Random draws come from numpy, so trees differ
from MLlib's in detail, and are equal where nothing is drawn. The result is MLlib's own model class, loaded from the
layout it is saved in.
"""

from __future__ import annotations

import json
import math
import pickle
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession

from carepanel.functions import tree_sums
from carepanel.functions.tree_sums import Layout, Split
from carepanel.sources.scratch import ensure_checkpoint_dir, ship_code

#: Rows of all sets together per partition: at least and at most; between them there is a partition per core.
LEAST_ROWS, MOST_ROWS = 20_000, 1_000_000
#: Rounds between checkpoints of the rows' margins.
CHECKPOINT_ROUNDS = 20
#: Partitions whose sums the driver adds up itself; those of more are first added up by the executors.
DIRECT_PARTS = 64
#: A split has to gain more than this share of what it is the difference of: below lies rounding.
ROUNDING = 1e-13

def thresholds_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's thresholds: between all neighbouring values if there are few, else where their weights fill a stride."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2.0
    stride = weights.sum() / bins
    found, current, wanted = [], weights[0], stride
    for i in range(1, len(values)):
        previous, current = current, current + weights[i]
        if abs(previous - wanted) < abs(current - wanted):
            found.append((values[i - 1] + values[i]) / 2.0)
            wanted += stride
    return np.array(found)


def best_splits(layout: Layout, bins: np.ndarray, allowed: np.ndarray) -> list[tuple[Split, float, tuple] | None]:
    """Per node the split of the greatest gain among its ``allowed`` slots (nodes x slots), its gain and the weight and
    sum of both sides; None for a node that no split improves."""
    nodes, start = len(bins), np.concatenate([[0], np.cumsum(layout.dims)])
    numbers, wide = len(layout.thresholds), max(layout.dims)
    padded = np.zeros((nodes, 2, len(layout.dims), wide))
    for c, d in enumerate(layout.dims):
        padded[:, :, c, :d] = bins[:, :, start[c] : start[c] + d]
    upto = np.cumsum(padded, axis=3)
    above = np.zeros_like(padded)
    above[..., :-1] = np.cumsum(padded[..., :0:-1], axis=3)[..., ::-1]  # sums of no rows stay exactly 0
    left, right = upto.copy(), above
    left[:, :, numbers:] = padded[:, :, numbers:]  # a level against all others
    right[:, :, numbers:, 1:] += upto[:, :, numbers:, :-1]
    (w_l, s_l), (w_r, s_r) = (x.transpose(1, 0, 2, 3) for x in (left, right))
    total, s = bins[:, :, : layout.dims[0]].sum(axis=2).T[:, :, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        split_up = (s_l**2 / w_l + s_r**2 / w_r) / total
        gain = split_up - (s / total) ** 2
    usable = (w_l > 0) & (w_r > 0)
    slot = np.zeros((len(layout.dims), wide), np.int64)
    real = np.zeros((len(layout.dims), wide), bool)
    for c in range(numbers):
        slot[c], real[c, : len(layout.thresholds[c])] = c, True
    first = numbers
    for c, n in enumerate(layout.levels, start=numbers):
        slot[c, :n], real[c, :n] = first + np.arange(n), True
        first += n
    gain = np.where(usable & real & allowed[:, slot], gain, -np.inf).reshape(nodes, -1)
    found: list[tuple[Split, float, tuple] | None] = []
    for j, at in enumerate(gain.argmax(axis=1)):
        if not gain[j, at] > ROUNDING * split_up.reshape(nodes, -1)[j, at]:
            found.append(None)
            continue
        c, i = divmod(int(at), wide)
        a, b = (w_l[j, c, i], s_l[j, c, i]), (w_r[j, c, i], s_r[j, c, i])
        split = Split(c, i, int(slot[c, i]), c < numbers)
        if not split.numeric:
            split.level_goes_right = bool(b[1] / b[0] <= a[1] / a[0])  # the smaller mean goes left
            if split.level_goes_right:
                a, b = b, a
        found.append((split, float(gain[j, at]), (a, b)))
    return found


def _slots_per_node(strategy: str, slots: int) -> int | None:
    """How many slots a node may use; None for a strategy that this module leaves to MLlib."""
    if strategy in ("all", "auto"):
        return slots
    try:
        share = float(strategy)
    except ValueError:
        return None
    if strategy.isdigit():
        return min(int(strategy), slots) if int(strategy) > 0 else None
    return math.ceil(share * slots) if 0 < share <= 1 else None


def fits_here(spec: GBTClassifier) -> bool:
    """Whether the parameters are those this module knows; anything else is for MLlib's own fit."""
    plain = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "lossType": "logistic"}
    same = all(spec.getOrDefault(name) == value for name, value in plain.items())
    return same and not spec.isDefined(spec.validationIndicatorCol) and _slots_per_node(spec.getFeatureSubsetStrategy(), 1) is not None


@dataclass
class Node:
    sums: np.ndarray | None = None
    mean: float = 0.0
    gain: float = -1.0
    split: Split | None = None


class Rows:
    """All sets' binned rows with their margins after the rounds so far: a stored RDD that each round replaces.

    Margins are checkpointed every ``CHECKPOINT_ROUNDS`` rounds, so a lost executor costs that many rounds at most. The
    pickled bytes are held as they are: a serialized copy would be read through Java's object streams at every level.
    """

    def __init__(self, rows: RDD):
        self.turn, self.file = 0, None
        self._keep(rows)

    def _keep(self, rows: RDD) -> None:
        self.rows, self.before = rows.persist(StorageLevel.MEMORY_AND_DISK_DESER), getattr(self, "rows", None)
        if self.turn % CHECKPOINT_ROUNDS == 0:
            self.rows.checkpoint()

    def grow(self, layouts: dict, trees: dict, values: dict, seed: int, share: float, step: float) -> None:
        """The rows after one more round; the next job makes them."""
        turn, self.turn = self.turn, self.turn + 1
        self._keep(self.rows.map(lambda p: tree_sums.grown(p, layouts[p.of], trees[p.of], values[p.of], turn, seed, share, step)))

    def drop_older(self) -> None:
        """To be called when a job has made the rows: those of the round before and older checkpoints are not read again."""
        if self.before is not None:
            self.before.unpersist()
            self.before = None
        file = self.rows.getCheckpointFile()
        if file is None:
            return
        if self.file is not None:
            context = self.rows.context
            path = context._jvm.org.apache.hadoop.fs.Path(self.file)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.file = file


def _sums(rows: RDD, per_part) -> dict:
    sums = rows.mapPartitions(per_part)
    if rows.getNumPartitions() > DIRECT_PARTS:
        return sums.treeReduce(tree_sums.added_up, 2)
    return reduce(tree_sums.added_up, sums.collect(), {})


def _fit_trees(rows: Rows, layouts: dict[int, Layout], spec: GBTClassifier) -> dict[int, list[dict[tuple[int, int], Node]]]:
    """All rounds of all sets: per set the trees, each a dict of nodes by (level, place)."""
    rounds, depth, step = spec.getMaxIter(), spec.getMaxDepth(), spec.getStepSize()
    share, seed = spec.getSubsamplingRate(), abs(spec.getSeed())
    per_node = {k: _slots_per_node(spec.getFeatureSubsetStrategy(), layout.slots) for k, layout in layouts.items()}
    forests: dict[int, list[dict]] = {k: [] for k in layouts}
    for turn in range(rounds):
        trees: dict[int, list[list[Split | None]]] = {k: [] for k in layouts}
        nodes: dict[int, dict[tuple[int, int], Node]] = {k: {(0, 0): Node()} for k in layouts}
        draws = {k: np.random.Generator(np.random.SFC64([seed, turn, k])) for k in layouts}
        for level in range(max(1, depth)):
            active = {k: np.array([p for (lv, p), node in nodes[k].items() if lv == level], np.int64) for k in layouts}
            if not any(len(a) for a in active.values()):
                break
            found = _sums(rows.rows, lambda p, t=trees, a=active: tree_sums.level_sums(p, layouts, t, a))
            if level == 0:
                rows.drop_older()
            for k, (bins, ended) in found.items():
                if level == 0 and turn:
                    _finish(forests[k][-1], ended)
                allowed = np.zeros((len(bins), layouts[k].slots), bool)
                for row in allowed:
                    row[draws[k].choice(len(row), per_node[k], replace=False)] = True
                best = best_splits(layouts[k], bins, allowed) if depth else [None] * len(bins)
                splits: list[Split | None] = [None] * 2**level
                for place, of_bins, choice in zip(active[k].tolist(), bins, best, strict=True):
                    node = nodes[k][(level, place)]
                    if level == 0:
                        w, s = of_bins[:, : layouts[k].dims[0]].sum(axis=1)
                        node.mean = s / w if w > 0 else 0.0
                    if choice:
                        splits[place], node.split, node.gain = choice[0], choice[0], choice[1]
                        for side, (w, s) in enumerate(choice[2]):
                            nodes[k][(level + 1, 2 * place + side)] = Node(mean=s / w)
                trees[k].append(splits)
            for k in layouts.keys() - found.keys():
                trees[k].append([None] * 2**level)
        values = {k: _leaf_values(nodes[k], trees[k]) for k in layouts}
        for k in layouts:
            forests[k].append(nodes[k])
        if turn + 1 < rounds:
            rows.grow(layouts, trees, values, seed, share, 1.0 if turn == 0 else step)
        else:
            places = {k: len(v) for k, v in values.items()}
            for k, (_, ended) in _sums(rows.rows, lambda p, t=trees, n=places: tree_sums.ended_sums(p, layouts, t, n)).items():
                _finish(forests[k][-1], ended)
    rows.rows.unpersist()
    return forests


def _leaf_values(nodes: dict[tuple[int, int], Node], tree: list) -> np.ndarray:
    """Means by place below the last level; a leaf further up has its own mean at the leftmost place below it."""
    values = np.zeros(2 ** len(tree))
    for (level, place), node in nodes.items():
        if node.split is None:
            values[place << (len(tree) - level)] = node.mean
    return values


def _finish(nodes: dict[tuple[int, int], Node], ended: np.ndarray) -> None:
    """Gives every node the sums counted in the rows of the places below it."""
    levels = len(ended).bit_length() - 1
    for (level, place), node in nodes.items():
        node.sums = ended[place << (levels - level) : (place + 1) << (levels - level)].sum(axis=0)


_NODE = pa.struct(
    [
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
        ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
        ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
    ]
)


def _node_rows(nodes: dict[tuple[int, int], Node], layout: Layout) -> list[dict]:
    """A tree's nodes as MLlib saves them, in pre-order."""
    rows: list[dict] = []

    def add(level: int, place: int) -> int:
        node, at = nodes[(level, place)], len(rows)
        n, w, s, ss = (float(x) for x in node.sums)
        split, sides = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}, (-1, -1)
        rows.append({})
        if node.split:
            one = node.split
            side = [float(layout.thresholds[one.column][one.at])] if one.numeric else [0.0 if one.level_goes_right else 1.0]
            split = {"featureIndex": one.slot, "leftCategoriesOrThreshold": side, "numCategories": -1 if one.numeric else 2}
            sides = add(level + 1, 2 * place), add(level + 1, 2 * place + 1)
        rows[at] = {
            "id": at, "prediction": node.mean, "impurity": (ss - s * s / w) / w, "impurityStats": [w, s, ss], "rawCount": round(n),
            "gain": node.gain if node.split else -1.0, "leftChild": sides[0], "rightChild": sides[1], "split": split,
        }
        return at

    add(0, 0)
    return rows


def as_model(spark: SparkSession, forest: list[dict], layout: Layout, spec: GBTClassifier) -> GBTClassificationModel:
    """MLlib's model of the fitted trees, loaded from the layout MLlib saves models in."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosted-{uuid.uuid4().hex}"
    known = {p.name for p in DecisionTreeRegressor().params}
    given, defaults = ({p.name: v for p, v in m.items()} for m in (spec._paramMap, spec._defaultParamMap))

    def described(kind: str, uid: str, keep: set[str] | None = None, **more) -> str:
        maps = {name: {n: v for n, v in m.items() if keep is None or n in keep} for name, m in (("paramMap", given), ("defaultParamMap", defaults))}
        return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, **maps, **more})

    text = described("org.apache.spark.ml.classification.GBTClassificationModel", spec.uid, numFeatures=layout.slots, numTrees=len(forest))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    of_tree = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    weights = [1.0 if i == 0 else float(spec.getStepSize()) for i in range(len(forest))]
    about = [(i, described(of_tree, f"dtr_{uuid.uuid4().hex[:12]}", known), w) for i, w in enumerate(weights)]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [(i, row) for i, nodes in enumerate(forest) for row in _node_rows(nodes, layout)]
    table = pa.table({"treeID": pa.array([i for i, _ in rows], pa.int32()), "nodeData": pa.array([r for _, r in rows], _NODE)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_side_by_side(table: DataFrame, numbers: int, levels: dict[int, list[int]], specs: dict[int, GBTClassifier], bins: int) -> dict[int, GBTClassificationModel]:
    """A model per set of ``table``: columns set, ``numbers`` scaled numbers, a level's place per categorical column,
    label (0 or 1) and weight, in this order. ``levels`` counts each set's levels by column, the specs differ in their
    names only. Sets without weight are left out of the result.
    """
    spark, width = table.sparkSession, len(table.columns) - 3
    ship_code(spark)
    blocks = table.mapInArrow(lambda batches: tree_sums.packed(batches, width), "block binary").rdd.map(lambda r: pickle.loads(r[0]))
    summary = blocks.mapPartitions(lambda b: tree_sums.summary(b, numbers)).treeReduce(tree_sums.merged, 2)
    wrong = set().union(*(s["labels"] for s in summary.values())) - {0, 1}
    if wrong or any(s["least"] < 0 for s in summary.values()):
        raise ValueError(f"labels have to be 0 or 1 and weights 0 or more; other labels: {sorted(wrong)}")
    summary = {k: s for k, s in summary.items() if s["weight"] > 0}
    if not summary:
        return {}
    layouts = {k: Layout([thresholds_of(v, w, min(bins, s["n"])) for v, w in s["columns"]], levels[k]) for k, s in sorted(summary.items())}
    n, cores = sum(s["n"] for s in summary.values()), spark.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // LEAST_ROWS), cores * max(1, -(-n // (MOST_ROWS * cores)))))
    kept = blocks.filter(lambda b: b[0] in layouts)
    dealt = kept.mapPartitionsWithIndex(lambda i, b: tree_sums.dealt(i, b, layouts, parts)).partitionBy(parts, lambda to: to)
    spec = next(iter(specs.values()))
    seed, share = abs(spec.getSeed()), spec.getSubsamplingRate()
    rows = Rows(dealt.mapPartitionsWithIndex(lambda i, pieces: tree_sums.gathered(i, pieces, seed, share)))
    forests = _fit_trees(rows, layouts, spec)
    with ThreadPoolExecutor(max(1, len(forests))) as pool:
        models = pool.map(lambda k: as_model(spark, forests[k], layouts[k], specs[k]), forests)
    return dict(zip(forests, models, strict=True))
