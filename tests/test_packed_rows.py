"""The classifier gets its training rows in as many partitions as their number asks for."""

import pytest
from pyspark.sql import functions as F

from carepanel.operators import modeling


def partitions(df):
    return df._jdf.queryExecution().toRdd().getNumPartitions()


@pytest.mark.parametrize("n, per_part, parts", [(0, 10, 1), (10, 10, 1), (11, 10, 2), (100, 10, 10), (100, 1, 40)])
def test_packed_keeps_the_rows_in_few_partitions(spark, n, per_part, parts):
    packed = modeling.packed(spark.range(100).repartition(40), n, per_part)
    assert partitions(packed) == parts
    assert packed.count() == 100


def test_the_estimator_reads_few_partitions_of_a_scattered_table(spark, monkeypatch):
    seen = []

    class Recorder(modeling.LogisticRegression):
        def fit(self, rows, params=None):
            seen.append((partitions(rows), rows.count()))
            return super().fit(rows, params)

    monkeypatch.setattr(modeling, "LogisticRegression", Recorder)
    i = F.col("id")
    rows = spark.range(60).select(i, (i % 2).cast("int").alias("y"), (i % 7).cast("double").alias("a"), F.concat(F.lit("k"), i % 3).alias("k"))
    model = modeling.fit(rows.repartition(30), "y", "logreg", ["a"], ["k"], maxIter=2)
    assert seen == [(1, 60)]
    assert modeling.predict(model, rows, ["id"]).count() == 60
