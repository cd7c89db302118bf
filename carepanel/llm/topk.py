"""Exact top-k inner products: columnar branch-and-bound over blocks of dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package, stored

BLOCK_ROWS = 65536
DIMENSIONS = 8
SCALED_LIMIT = 2**31 - 1
RESULT = "query_id long, query_key long, vec_id long, score long"


def scaled_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Distinct ``id``, ``v`` (floor(scale * x) of every component, as int) of the vectors that can be scored.

    Vectors that are null, hold null or non-finite components, or components that leave 31 bits when scaled (their
    products would leave a long) take no part; neither do rows with a null id. Rows that repeat id and vector count once.
    """
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(F.col(vector_col), lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < SCALED_LIMIT))
    usable = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(fits, F.lit(False)))
    return usable.select(F.col(id_col).cast("long").alias("id"), x.cast("array<int>").alias("v")).distinct()


def _matrix(table: pa.Table) -> np.ndarray:
    """The vectors of a block, one row per vector."""
    flat = [c.flatten().to_numpy() for c in table.column("v").chunks]
    values = np.concatenate(flat)
    return values.reshape(table.num_rows, len(values) // table.num_rows)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(score) > k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        pool = np.flatnonzero(score >= floor)
    else:
        pool = np.arange(len(score))
    return pool[np.lexsort((ids[pool], -score[pool]))][:k]


def search_block(query_ids, queries, cand_ids, candidates, k: int):
    """Per query the k best rows of one candidate block, by branch and bound over vertical dimension blocks.

    Candidates lie column by column. Scores of all are accumulated one block of dimensions at a time; after each block
    a candidate survives if its partial score plus the Cauchy-Schwarz bound on the remaining mass reaches the score
    of the k-th best so far, and the survivors are compacted before the next block. Equal bounds survive, so ties stay
    exact. Yields (query position, candidate positions, scores).
    """
    widest = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, candidates.shape[1])
    kind = np.float64 if widest < 2**52 else np.int64  # either way sums are exact
    order = np.argsort(-np.square(candidates.astype(np.float64)).sum(axis=0), kind="stable")  # heaviest dimensions first
    columns = np.ascontiguousarray(candidates.T[order]).astype(kind)
    asked = queries[:, order].astype(kind)
    cuts = list(range(0, columns.shape[0], DIMENSIONS))
    mass = lambda m, axis: np.sqrt(np.square(m.astype(np.float64)).sum(axis=axis))
    rest_c = [mass(columns[c + DIMENSIONS :], 0) for c in cuts]
    seeds = np.arange(min(len(cand_ids), 64 * k))  # scored in full to have a bound from the start
    for n, query in enumerate(asked):
        others = seeds[cand_ids[seeds] != query_ids[n]]
        full = query @ columns[:, others]
        bound = -np.inf if len(full) < k else np.partition(full, len(full) - k)[len(full) - k]
        alive, score = np.flatnonzero(cand_ids != query_ids[n]), None
        for cut, rest in zip(cuts, rest_c, strict=True):
            part = query[cut : cut + DIMENSIONS]
            block = columns[cut : cut + DIMENSIONS]
            if score is None:
                score = (part @ block)[alive]
            else:
                score = score + part @ (block if len(alive) == columns.shape[1] else block[:, alive])
            reach = score + mass(query[cut + DIMENSIONS :], None) * rest[alive] * (1 + 1e-9) + 1e-6
            keep = reach >= bound
            if not keep.all():
                alive, score = alive[keep], score[keep]
        if score is None:  # vectors without components
            score = np.zeros(len(alive))
        best = _best(score, cand_ids[alive], k)
        yield n, alive[best], score[best]


def _tile(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    rows = []
    if queries.num_rows and candidates.num_rows:
        q_ids, c_ids = (t.column("id").to_numpy() for t in (queries, candidates))
        q_keys = queries.column("query_key").to_numpy()
        for n, at, score in search_block(q_ids, _matrix(queries), c_ids, _matrix(candidates), k):
            rows.append(pd.DataFrame({"query_id": q_ids[n], "query_key": q_keys[n], "vec_id": c_ids[at], "score": score.astype(np.int64)}))
    schema = pa.schema([(c, pa.int64()) for c in ("query_id", "query_key", "vec_id", "score")])
    if not rows:
        return schema.empty_table()
    return pa.Table.from_pandas(pd.concat(rows), schema=schema, preserve_index=False)


def top_inner_products(table: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of each query with all rows but its own: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; ties go to the smaller id, fewer rows than k give all.
    Queries and candidates are cut into blocks by a hash of id and vector, and each pair of blocks is one group, so a
    task holds one block of either side whatever the table's size; each group sends k rows per query on. Vectors of
    different length are not compared. Of rows that repeat an id, those with different vectors are separate rows;
    a query is never compared with rows of its own id. An empty table gives no rows.
    """
    spark = table.sparkSession
    ship_package(spark)
    rows = stored(scaled_vectors(table, id_col, vector_col).withColumn("dims", F.size("v")).withColumn("query_key", F.xxhash64("id", "v")), "vectors")
    asked = rows.where(F.col("id") % every == 0)
    n_rows, n_asked = rows.count(), asked.count()
    cores = spark.sparkContext.defaultParallelism
    cand_blocks = max(-(-n_rows // BLOCK_ROWS), min(2 * cores, -(-n_rows // 1024)), 1)
    query_blocks = max(-(-n_asked // BLOCK_ROWS), 1)
    block = lambda n: F.pmod("query_key", F.lit(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("id", "query_key", "v", "dims", block(query_blocks).alias("qb"), numbers(cand_blocks).alias("cb"))
    right = rows.select("id", "v", "dims", block(cand_blocks).alias("cb"), numbers(query_blocks).alias("qb"))
    keys = ["dims", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda q, c: _tile(q, c, k), RESULT)
    # the best k of a query: one small sorted array per query, cut before and after the shuffle
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id")
    best = found.groupBy("query_id", "query_key").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.minus")).alias("score"),
    )
