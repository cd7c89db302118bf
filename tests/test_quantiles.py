import math
import random

import duckdb
import pytest

from carepanel.functions.quantiles import exact_quantiles


def test_distinct_doubles_match_duckdb(spark):
    draw = random.Random(5)
    rows = [(draw.uniform(-1e6, 1e6), draw.choice([1.0, 2.0, None, float("nan")]), 7.0) for _ in range(20000)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, ["x", "y", "z"], probabilities, parts=16)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (x DOUBLE, y DOUBLE, z DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(x, None if y is not None and math.isnan(y) else y, z) for x, y, z in rows])
    for column in ("x", "y", "z"):
        expected = con.execute(f"SELECT quantile_cont({column}, {probabilities}) FROM t").fetchone()[0]
        assert got[column] == pytest.approx(expected, rel=1e-12, abs=1e-9), column


def test_hot_value_empty_and_single(spark):
    hot = spark.createDataFrame([(5.0,)] * 3000 + [(float(i),) for i in range(1000)] + [(None,)], "x double")
    got = exact_quantiles(hot, ["x"], [0.1, 0.5, 0.9], parts=8)["x"]
    ordered = sorted([5.0] * 3000 + [float(i) for i in range(1000)])
    for p, value in zip([0.1, 0.5, 0.9], got):
        at = (len(ordered) - 1) * p
        lo, hi = math.floor(at), math.ceil(at)
        assert value == pytest.approx(ordered[lo] + (at - lo) * (ordered[hi] - ordered[lo]))
    assert exact_quantiles(hot.limit(0), ["x"], [0.5]) == {"x": [None]}
    assert exact_quantiles(hot.where("x = 3"), ["x"], [0.0, 0.5, 1.0]) == {"x": [3.0, 3.0, 3.0]}
    assert exact_quantiles(hot.where("x is null"), ["x"], [0.5]) == {"x": [None]}


def test_agrees_with_spark_percentile(spark):
    draw = random.Random(9)
    df = spark.createDataFrame([(draw.randrange(50),) for _ in range(5000)], "k long")
    expected = df.selectExpr("percentile(k, array(0.3, 0.5, 0.95))").first()[0]
    assert exact_quantiles(df, ["k"], [0.3, 0.5, 0.95], parts=4)["k"] == expected
