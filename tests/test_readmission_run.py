"""The whole readmission run on a small table with short training."""

import json

from conftest import rows
import pytest
from pyspark.sql import functions as F

from carepanel.operators import cleaning, modeling
from carepanel.operators import encounter_features as ef
from carepanel.plans import readmission_job
from carepanel.sources import sinks
from carepanel.sources.fixture_views import view

SHORT = {"logreg": {"maxIter": 20}, "gbm": {"maxIter": 2}}


def test_run_writes_every_table(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = view(spark, sf_dir, "admissions")
    as_text = raw.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns))  # as in the raw file
    written = readmission_job.run(as_text, root, SHORT)
    assert "patient_risk_scores" in written and "bi/patient_level" in written
    features, scores = spark.read.parquet(f"{root}/features"), spark.read.parquet(f"{root}/scores")
    assert scores.count() == features.count() == scores.select("patient_id").distinct().count()
    assert scores.where("probability NOT BETWEEN 0 AND 1 OR top_3_risk_factors IS NULL").count() == 0
    champion = modeling.saved_champion(spark, root)
    document = json.loads("".join(p.read_text() for p in (tmp_path / "metrics").glob("part-*.txt")))
    assert document["champion"] == champion and set(document["models"]) == {"logreg", "gbm"}
    again = modeling.predict(modeling.load_champion(root), features, [cleaning.PATIENT])
    assert again.count() == features.count()
    sweep = sinks.read_published(spark, root, "threshold_sweep")
    assert sweep.count() == 101
    assert modeling.saved_champion(spark, f"{root}/nowhere") == "gbm"


def test_unseen_levels_and_missing_values(spark, sf_dir):
    features = ef.build_features(cleaning.clean(view(spark, sf_dir, "admissions"))).cache()
    model = modeling.fit(features, cleaning.TARGET, "logreg", maxIter=5)
    odd = features.selectExpr("* EXCEPT (race, age_midpoint)", "'Unseen' AS race", "CAST(NULL AS DOUBLE) AS age_midpoint")
    out = modeling.predict(model, odd, [cleaning.PATIENT])
    assert out.where("probability IS NULL").count() == 0


def test_split_is_stable_and_about_a_fifth(spark):
    ids = spark.range(5000).selectExpr("id AS patient_nbr", "CAST(id % 11 = 0 AS INT) AS label")
    first, second = (rows(modeling.with_split(x, "patient_nbr", "label")) for x in (ids, ids.repartition(7)))
    assert first == second
    folds = modeling.with_folds(ids, "patient_nbr", "label").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert abs(sum(t for *_, t in first) - 1000) <= 2


def test_registry_refuses_a_changed_schema(spark, sf_dir, tmp_path):
    from carepanel.operators import encounter_features as ef
    from carepanel.plans.model_queries import _features
    from carepanel.sources import model_registry

    features = _features(spark, sf_dir)
    model = modeling.fit(features, cleaning.TARGET, "logreg")
    columns = [*ef.NUMERIC_FEATURES, *ef.CATEGORICAL_FEATURES]
    root = str(tmp_path / "registry")
    assert model_registry.register(model, features, columns, root, "m") == 1
    assert model_registry.register(model, features, columns, root, "m") == 2
    loaded = model_registry.load_for(spark, features, root, "m")
    same = modeling.predict(loaded, features, [cleaning.PATIENT]).join(modeling.predict(model, features, [cleaning.PATIENT]).withColumnRenamed("probability", "p"), cleaning.PATIENT)
    assert same.where("probability != p").count() == 0
    changed = features.withColumn(ef.NUMERIC_FEATURES[0], F.col(ef.NUMERIC_FEATURES[0]).cast("string"))
    with pytest.raises(ValueError, match="differs"):
        model_registry.load_for(spark, changed, root, "m")
    with pytest.raises(ValueError, match="lack"):
        model_registry.load_for(spark, features.drop(ef.CATEGORICAL_FEATURES[0]), root, "m")
