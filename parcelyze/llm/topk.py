"""Exact top-k inner products by aggregation without random access (NRA).

Rows are dealt into data blocks and queries into query blocks; a task gets one
block of each. In its data block every component is a list of the rows sorted by
value, read from the top where the query's component is positive and from the
bottom where it is negative, so that contributions only fall. After each
reading depth a row has
  lower bound = what was read of it + the least that its other lists can add,
  upper bound = what was read of it + the last value read of its other lists.
Reading stops when no unread row, and few read ones, can still reach the k-th
lower bound; the scores of those few are then completed. Rows whose upper bound
equals the k-th lower bound are kept, so ties are resolved by id.

The k best of each block are merged per query. Vectors that are NULL or hold a
NULL or non-finite component take no part; a component that a shorter vector
lacks counts as 0. Scores are integers (components are floor(scale * x)).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Lists:
    """The sorted lists of one data block."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.down = np.argsort(-vectors, axis=0, kind="stable").T           # (components, rows)
        self.value = np.take_along_axis(vectors.T, self.down, axis=1)

    def best(self, query: np.ndarray, k: int, first: int = 16, few: int = 4) -> np.ndarray:
        """Rows that hold the k best scores, ties included."""
        n = len(self.vectors)
        if k >= n or not len(query):
            return np.arange(n)
        up = query < 0
        rows = np.where(up[:, None], self.down[:, ::-1], self.down)
        adds = np.where(up[:, None], self.value[:, ::-1], self.value) * query[:, None]
        least = adds[:, -1]
        read, floor, depth, step = np.zeros(n), np.full(n, float(least.sum())), 0, first
        while True:
            to = min(n, depth + step)
            new = rows[:, depth:to].ravel()
            read += np.bincount(new, adds[:, depth:to].ravel(), n)
            floor -= np.bincount(new, np.repeat(least, to - depth), n)
            depth, step = to, to
            lower = read + floor
            kth = np.partition(lower, n - k)[n - k]
            last = adds[:, depth - 1]
            if depth == n:
                return np.flatnonzero(lower >= kth)
            if last.sum() >= kth:                      # a row not read at all could still qualify
                continue
            seen = np.bincount(rows[:, :depth].ravel(), np.repeat(last, depth), n)
            able = np.flatnonzero(read + last.sum() - seen >= kth)
            if len(able) <= few * k:
                return able


def _matrix(column: pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def top_k(vectors: DataFrame, is_query: Column, id_col="vec_id", vector_col="embedding", k: int = 10,
          scale: float = 1024.0, block_rows: int = 512, block_queries: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row where ``is_query``
    holds, against all rows with another id. Blocks are of about ``block_rows``
    and ``block_queries`` rows: a task's memory does not grow with the input. The
    number of blocks comes from one counting pass."""
    v = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("q"))
    c = v.agg(F.count("*").alias("n"), F.count_if("q").alias("q"), F.max(F.size("v")).alias("w")).first()
    schema = "query_id long, vec_id long, score long"
    spark = vectors.sparkSession
    if not c["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_rows, n_queries, width = -(-c["n"] // block_rows), -(-c["q"] // block_queries), c["w"]
    block = F.pmod(F.monotonically_increasing_id(), F.lit(n_rows)).cast("int")
    data = v.select("id", "v", block.alias("d")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    asked = v.filter("q").dropDuplicates(["id"]).select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(n_queries)).cast("int").alias("b")).withColumn(
        "d", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

    def block_best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(rows) and len(queries):
            ids = rows.column("id").to_numpy()
            lists = Lists(_matrix(rows.column("v"), width, scale))
            for qid, q in zip(queries.column("id").to_pylist(), _matrix(queries.column("v"), width, scale)):
                own = int((ids == qid).sum())
                found = lists.best(q, k + own)
                found = found[ids[found] != qid]
                score = lists.vectors[found] @ q               # resolve: integers, exact in doubles
                order = np.lexsort((ids[found], -score))[:k]
                out[0].extend([qid] * len(order))
                out[1].extend(ids[found][order].tolist())
                out[2].extend(score[order].astype(np.int64).tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    best = data.groupBy("b", "d").cogroup(asked.groupBy("b", "d")).applyInArrow(block_best, schema)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
