import statistics

from pyspark.ml import Pipeline

from carepanel.operators import modeling


def test_missing_numbers_take_the_exact_median_of_training_rows(spark):
    values = [0.1 * i for i in range(1001)] + [None] * 5
    train = spark.createDataFrame([(v, "a" if i % 2 else None) for i, v in enumerate(values)], "x double, g string")
    stages = modeling.preprocessing(train, ["x"], ["g"])
    filled = Pipeline(stages=stages[:2]).fit(train).transform(train)
    fills = {r.x_n for r in filled.where("x IS NULL").collect()}
    assert fills == {statistics.median(v for v in values if v is not None)}
    read = {name: float(value) for value, name in modeling.MEDIAN_FILL.findall(stages[1].getStatement())}
    assert read == {"x": fills.pop()}


def test_a_column_without_values_is_filled_with_zero(spark):
    train = spark.createDataFrame([(None, "a"), (None, "b")], "x double, g string")
    filled = Pipeline(stages=modeling.preprocessing(train, ["x"], ["g"])[:2]).fit(train).transform(train)
    assert {r.x_n for r in filled.collect()} == {0.0}
