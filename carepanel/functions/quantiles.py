"""Exact quantiles by distributed selection, for columns with any number of distinct values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carepanel.sources.scratch import settled

#: Value ranges per column; only their totals come to the driver.
PARTS = 64


def _part_of(splitters: dict[str, list[float]]) -> Column:
    """The range of a value: how many of its column's splitters lie at or below it."""
    if not splitters:
        return F.lit(0)
    table = F.create_map(*[x for c, s in splitters.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in s]).cast("array<double>"))])
    return F.aggregate(F.coalesce(table[F.col("c")], F.array().cast("array<double>")), F.lit(0), lambda n, s: n + (F.col("v") >= s).cast("int"))


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], parts: int = PARTS) -> dict[str, list[float | None]]:
    """Per column, the exact quantiles at ``probabilities`` with linear interpolation between neighbouring ranks, as
    Spark's ``percentile`` and DuckDB's ``quantile_cont`` give them. Null and NaN values take no part; a column without
    values has None for each probability.

    Counts per (column, value) are combined map-side, dealt into ``parts`` value ranges per column by sampled
    splitters (which only shape the work, never the result), and the totals per range come to the driver. A prefix
    sum over them tells which range holds each wanted rank; only those ranges are read again, each in one task in
    value order. No task holds more than one range of distinct values, and the driver gets parts plus two rows per
    quantile and column.
    """
    values = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")
    ).select("e.c", "e.v")
    counts = settled(values.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    cuts = [i / parts for i in range(1, parts)]
    splitters = {r["c"]: sorted(set(r["s"] or [])) for r in counts.groupBy("c").agg(F.percentile_approx("v", cuts, 10000).alias("s")).collect()}
    dealt = counts.withColumn("part", _part_of(splitters))
    totals: dict[str, dict[int, int]] = {}
    for r in dealt.groupBy("c", "part").agg(F.sum("n").alias("n")).collect():
        totals.setdefault(r["c"], {})[r["part"]] = r["n"]
    wanted: dict[tuple[str, int], set[int]] = {}
    positions: dict[str, list[tuple[float, int, int]]] = {}
    for c in columns:
        per_part = sorted(totals.get(c, {}).items())
        n = sum(k for _, k in per_part)
        positions[c] = []
        for p in probabilities:
            if n == 0:
                continue
            at = (n - 1) * p
            for rank in {math.floor(at), math.ceil(at)}:
                start = 0
                for part, k in per_part:
                    if rank < start + k:
                        wanted.setdefault((c, part), set()).add(rank - start)
                        break
                    start += k
            positions[c].append((at, math.floor(at), math.ceil(at)))
    found: dict[tuple[str, int], float] = {}
    if wanted:
        in_part = Window.partitionBy("c", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = dealt.where(F.struct("c", "part").isin(*[F.struct(F.lit(c), F.lit(p)) for c, p in wanted])).withColumn(
            "upto", F.sum("n").over(in_part)
        )
        hit = F.lit(False)
        for (c, part), ranks in wanted.items():
            for rank in ranks:
                hit = hit | ((F.col("c") == c) & (F.col("part") == part) & (F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank))
        starts = {c: {} for c in columns}
        for c in columns:
            start = 0
            for part, k in sorted(totals.get(c, {}).items()):
                starts[c][part] = start
                start += k
        for r in ranked.where(hit).collect():
            key, start = (r["c"], r["part"]), starts[r["c"]][r["part"]]
            for rank in wanted[key]:
                if r["upto"] - r["n"] <= rank < r["upto"]:
                    found[(r["c"], start + rank)] = r["v"]
    out = {}
    for c in columns:
        if not positions[c]:
            out[c] = [None] * len(probabilities)
            continue
        out[c] = [
            found[(c, lo)] if lo == hi else (hi - at) * found[(c, lo)] + (at - lo) * found[(c, hi)] for at, lo, hi in positions[c]
        ]
    return out


def exact_quantile(df: DataFrame, column: str, probability: float) -> float | None:
    return exact_quantiles(df, [column], [probability])[column][0]
