"""Run registered queries on Spark and their twins on DuckDB and compare the rows.

    python tests/compare.py SF_DIR [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).df()


def _cell(v):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def kinds(pdf):
    out = {}
    for c in pdf.columns:
        k = pdf[c].dtype.kind
        if k == "O" or k == "T":
            vals = [v for v in pdf[c].dropna()]
            k = type(vals[0]).__name__ if vals else "null"
        out[c] = {"str": "s", "U": "s", "i": "i", "u": "i"}.get(k, k)
    return out


def schema_kinds(df, pdf):
    """Kinds of a Spark result from its schema where pandas would guess: an all-null integer column is still integral."""
    out = kinds(pdf)
    for field in df.schema.fields:
        name = field.dataType.typeName()
        if name in ("byte", "short", "integer", "long"):
            out[field.name] = "i"
        elif name in ("float", "double"):
            out[field.name] = "f"
    return out


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_cell(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))


def compare(spark, sf_dir, fn, sql):
    result = fn(spark, sf_dir)
    left = result.toPandas()
    right = duck_rows(sf_dir, sql)
    lc, lr = rows_of(left)
    rc, rr = rows_of(right)
    problems = []
    if lc != rc:
        problems.append(f"columns {lc} != {rc}")
    elif lr != rr:
        only_l = [r for r in lr if r not in set(rr)][:2]
        only_r = [r for r in rr if r not in set(lr)][:2]
        problems.append(f"rows {len(lr)}/{len(rr)}\n   spark {only_l}\n   duck  {only_r}")
    lk, rk = schema_kinds(result, left), kinds(right)
    bad = {c: (lk[c], rk.get(c)) for c in lk if lk[c] != rk.get(c) and "null" not in (lk[c], rk.get(c))}
    if bad and lc == rc:
        problems.append(f"kinds {bad}")
    return len(lr), problems


def make_session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:]) or ("",)
    spark = make_session()
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sorted(queries):
        if not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            if name in oracles:
                n, problems = compare(spark, sf_dir, queries[name], oracles[name])
            else:
                n, problems = queries[name](spark, sf_dir).count(), []
        except Exception as e:  # report and go on to the next query
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:900]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in oracles else "rows")
        print(f"{mark:5s} {name:44s} {n:7d} {time.time() - t:6.2f}s", *problems, flush=True)
    print("failed:", failed)
