"""Boosted trees of several folds grown in lockstep are those that MLlib fits for each of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepanel.functions import tree_sums
from carepanel.operators import boosting, modeling

NUMBERS, LEVELS = ["a", "b", "c"], ["k", "m"]
#: Without random draws the algorithm has one result.
SURE = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


def rows_of(spark, n=900):
    """Numbers of many and of few values, with nulls, levels of which one is rare, and a label that depends on them."""
    i = F.col("id")
    draw = lambda s: F.pmod(F.xxhash64(i, F.lit(s)), F.lit(100_003)) / 100_003.0
    df = spark.range(n).select(i, draw(1).alias("a"), F.floor(draw(2) * 5).cast("double").alias("b"), (draw(3) * 40 - 20).alias("c"), draw(4).alias("u"))
    df = df.withColumn("b", F.when(i % 11 != 0, F.col("b")))
    df = df.withColumns({"k": F.concat(F.lit("k"), (F.floor(draw(5) * 4)).cast("string")), "m": F.when(i == 7, "rare").when(i % 5 == 0, None).otherwise(F.concat(F.lit("m"), F.floor(draw(6) * 3).cast("string")))})
    y = 2 * F.col("a") + F.col("u") + F.when(F.col("k") == "k1", 0.6).otherwise(0) + F.when(F.col("b") > 2, 0.4).otherwise(0) > 2.0
    return df.withColumn("y", F.coalesce(y, F.lit(False)).cast("int")).drop("u").withColumn("fold", (i % 3).cast("int")).cache()


def trees(model):
    """The tree's text without its name."""
    return [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]


def test_lockstep_trees_equal_mllib(spark):
    rows = rows_of(spark)
    trains = [rows.where(F.col("fold") != k) for k in range(2)]
    options = {**SURE, "maxIter": 6, "maxDepth": 3, "stepSize": 0.3}
    together = modeling.fit_boosted(trains, "y", NUMBERS, LEVELS, **options)
    for train, ours in zip(trains, together, strict=True):
        mllib = modeling.fit(train, "y", "gbm", NUMBERS, LEVELS, **options)
        assert ours.stages[-1].treeWeights == mllib.stages[-1].treeWeights and ours.stages[-1].numFeatures == mllib.stages[-1].numFeatures
        assert [t.count("If") for t in trees(ours)] == [t.count("If") for t in trees(mllib)]
        assert np.allclose(ours.stages[-1].featureImportances.toArray(), mllib.stages[-1].featureImportances.toArray(), atol=1e-9)
        both = [{r.id: r.probability for r in modeling.predict(m, rows, ["id"]).collect()} for m in (ours, mllib)]
        assert both[0].keys() == both[1].keys() and len(both[0]) == 900
        assert max(abs(both[0][i] - both[1][i]) for i in both[0]) < 1e-9
        assert np.std(list(both[0].values())) > 0.05


def test_out_of_fold_boosting_starts_a_job_per_level_for_all_folds(spark, monkeypatch):
    """Fitting every fold on its own starts a job per level and fold, so the jobs grow with the folds."""
    jobs = []
    real = boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda *a: jobs.append(1) or real(*a))
    rows = rows_of(spark).drop("fold").withColumns({c: F.lit(1.0) for c in modeling.NUMERIC_FEATURES} | {c: F.col("k") for c in modeling.CATEGORICAL_FEATURES})
    rows = rows.withColumn("age_midpoint", F.col("a")).withColumn("num_medications", F.col("c"))
    scored = modeling.out_of_fold(rows, "id", "y", "gbm", folds=3, maxIter=2, maxDepth=2)
    assert len(jobs) == 2 * 2 + 1
    found = scored.collect()
    assert sorted(r.id for r in found) == list(range(900))
    assert {(r.fold, r.n_train) for r in found} == {(k, 900 - sum(r.fold == k for r in found)) for k in range(3)}
    assert all(0 < r.probability < 1 for r in found)


def test_margins_survive_checkpoints_and_drawn_rows_repeat(spark, monkeypatch):
    rows = rows_of(spark)
    options = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.7", "maxIter": 5, "maxDepth": 2}
    fitted = []
    for every in (2, 100):
        monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", every)
        fitted.append(modeling.fit_boosted([rows, rows.where("fold > 0")], "y", NUMBERS, LEVELS, **options))
    for one, other in zip(*fitted, strict=True):
        assert trees(one) == trees(other)
    assert len(set(trees(fitted[0][0]))) == 5  # each round its own tree


def test_more_partitions_give_the_same_trees(spark, monkeypatch):
    rows, options = rows_of(spark), {**SURE, "maxIter": 3, "maxDepth": 3}
    whole = modeling.fit_boosted([rows], "y", NUMBERS, LEVELS, **options)[0]
    monkeypatch.setattr(boosting, "LEAST_ROWS", 50)
    monkeypatch.setattr(tree_sums, "MOST_CODES", 8)
    monkeypatch.setattr(boosting, "DIRECT_PARTS", 2)
    dealt = modeling.fit_boosted([rows.repartition(5)], "y", NUMBERS, LEVELS, **options)[0]
    both = [{r.id: r.probability for r in modeling.predict(m, rows, ["id"]).collect()} for m in (whole, dealt)]
    assert max(abs(both[0][i] - both[1][i]) for i in both[0]) < 1e-9


def test_a_set_without_positives_is_left_to_mllib(spark):
    """All weights of a set of positives only are 0, which MLlib answers its own way."""
    rows = rows_of(spark)
    assert not boosting.fits_here(modeling.estimator("gbm", "y", 1, minInstancesPerNode=5))
    assert not boosting.fits_here(modeling.estimator("gbm", "y", 1, featureSubsetStrategy="sqrt"))
    assert boosting.fits_here(modeling.estimator("gbm", "y", 1))
    none = modeling.fit_boosted([rows.where("y = 0")], "y", NUMBERS, LEVELS, maxIter=2, maxDepth=2)[0]
    assert max(r.probability for r in modeling.predict(none, rows, ["id"]).collect()) < 0.5


@pytest.mark.parametrize("n", [3, 40, 5000])
def test_thinned_summaries_keep_all_weight(n):
    values = np.random.default_rng(1).normal(size=n)
    kept, weights = tree_sums.thinned(values, np.full(n, 0.5), most=100)
    assert len(kept) <= 100 and np.isclose(weights.sum(), n / 2) and (np.diff(kept) > 0).all() and kept[-1] == values.max()
    if n <= 100:
        assert (kept == np.sort(values)).all()
