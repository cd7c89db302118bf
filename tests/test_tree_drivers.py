import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carepanel.operators import cleaning, modeling, tree_drivers
from carepanel.operators import encounter_features as ef
from carepanel.plans.model_queries import _features


def test_boosted_contributions_add_up_to_the_margin(spark, sf_dir):
    features = _features(spark, sf_dir)
    model = modeling.fit(features, cleaning.TARGET, "gbm", maxIter=30)
    explained = tree_drivers.with_tree_contributions(model, features.withColumn(modeling.WEIGHT, F.lit(1.0)), ef.NUMERIC_FEATURES, ef.CATEGORICAL_FEATURES)
    total = F.aggregate("contributions", F.col("bias"), lambda a, c: a + c["value"])
    rows = explained.select(cleaning.PATIENT, (total - F.col("margin")).alias("gap"), F.size("contributions").alias("n")).collect()
    assert len(rows) == features.count()
    assert max(abs(r.gap) for r in rows) < 1e-6
    assert {r.n for r in rows} == {len(dict.fromkeys(tree_drivers.slot_features(model, ef.NUMERIC_FEATURES, ef.CATEGORICAL_FEATURES)))}


def test_the_plan_does_not_grow_with_the_trees(spark, sf_dir):
    """The trees are data of the walk: neither literals nor expressions of the plan."""
    features = _features(spark, sf_dir).withColumn(modeling.WEIGHT, F.lit(1.0))
    sizes = []
    for rounds in (2, 12):
        model = modeling.fit(features, cleaning.TARGET, "gbm", maxIter=rounds)
        explained = tree_drivers.with_tree_contributions(model, features, ef.NUMERIC_FEATURES, ef.CATEGORICAL_FEATURES)
        sizes.append(len(explained.select("contributions")._jdf.queryExecution().analyzed().toString()))
    assert sizes[1] < 1.05 * sizes[0]


def test_a_walk_follows_thresholds_and_category_sets():
    """Tree 1: slot 0 <= 1.5, then category set {0, 2} of slot 1; tree 2: a lone leaf."""
    nodes = {
        "roots": np.array([0, 5]),
        "left": np.array([1, -1, 3, -1, -1, -1]),
        "right": np.array([2, -1, 4, -1, -1, -1]),
        "slot": np.array([0, -1, 1, -1, -1, -1]),
        "threshold": np.array([1.5, 0, 0, 0, 0, 0]),
        "mean": np.array([1.0, 2.0, 4.0, 8.0, 16.0, 3.0]),
        "set_of": np.array([-1, -1, 0, -1, -1, -1]),
        "goes_left": np.array([[True, False, True, False]]),
    }
    walk = tree_drivers._walker(nodes, [0.5, 1.0], np.array([0, 1]), 2)
    rows = [[1.5, 0.0], [2.0, 2.0], [2.0, 1.0], [float("nan"), 7.0]]
    assert walk(pa.array(rows)).to_pylist() == [[0.5, 0.0], [1.5, 2.0], [1.5, 6.0], [1.5, 6.0]]
    assert walk(pa.array([], pa.list_(pa.float64()))).to_pylist() == []
