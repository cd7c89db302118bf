"""Connected components by random contraction, without gathering a node's neighbours anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import stored


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of the edges; two nodes share a root exactly if a path joins them.

    In each round every node moves onto the neighbour (or itself) that comes first in an order drawn anew by hashing;
    edges are then contracted and made distinct. In expectation a constant share of the nodes vanishes per round
    whatever the graph looks like, so chains and stars take a logarithmic number of rounds. A node with many
    neighbours only ever meets them in a minimum (combined map-side) and in a join that can be split.
    Edges with a null end and loops are dropped; no edges give no rows.
    """
    work = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    work, labels, turn = stored(work, "links"), None, 0
    while not work.isEmpty():
        both = work.union(work.select("b", "a"))
        order = F.struct(F.xxhash64(F.lit(turn), "b").alias("h"), F.col("b").alias("node"))
        moves = both.groupBy("a").agg(F.min(order).alias("first")).select(
            F.col("a").alias("node"),
            F.when(F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("node")) < F.col("first"), F.col("a"))
            .otherwise(F.col("first.node")).alias("to"),
        )
        moves = stored(moves, "moves")
        labels = moves.withColumnRenamed("to", "root") if labels is None else _moved(labels, moves)
        labels = stored(labels, "labels")
        ends = [moves.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab"]
        joined = work.join(ends[0], "a").join(ends[1], "b")
        work = stored(joined.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).where("a <> b").distinct(), "links")
        turn += 1
    if labels is None:
        return edges.select(F.col(left).alias("node"), F.col(left).alias("root")).limit(0)
    return labels


def _moved(labels: DataFrame, moves: DataFrame) -> DataFrame:
    moves = moves.select(F.col("node").alias("root"), "to")
    return labels.join(moves, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
