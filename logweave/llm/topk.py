"""Exact top-k inner products without random access to the vectors.

Vectors and queries are dealt into blocks by a hash; each pair of blocks is one task.  Inside a block,
every dimension has its list sorted by value, read from the top where the query's component is
positive and from the bottom where it is negative.  After each round of reading, a vector's score
lies between a lower bound (unread components at the list's far end) and an upper bound (unread
components at the reading front).  A vector whose upper bound is below the query's k-th best lower
bound can never qualify and is dropped; reading stops when the lists are read or only the last rounds'
vectors remain, whose final scores are then resolved.  The k best of each block meet in one window
per query.

Bounds of all queries of a block are matrix products over clipped component values, so a round costs
two products.  Work is queries times vectors, as the question asks; memory is one pair of blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import ship, table

VECTOR_BLOCK = 8192
QUERY_BLOCK = 4096
QUERY_STEP = 512
#: Shares of each sorted list that the rounds have read.
ROUNDS = (0.25, 0.6)
RESULT = "query_id long, vec_id long, score long"


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """floor(64 * x) of every component as whole numbers in doubles; shorter vectors end in zeros."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    flat = np.floor(64.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def block_top(query_ids: np.ndarray, q: np.ndarray, vec_ids: np.ndarray, x: np.ndarray, k: int,
              rounds: tuple[float, ...] = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's ``k`` best; ties go to smaller vector ids."""
    by = np.argsort(vec_ids, kind="stable")
    vec_ids, x = vec_ids[by], x[by]
    m = len(x)
    bound = max(np.abs(q).sum(1).max(initial=0) * np.abs(x).max(initial=0), 1.0)
    if bound >= 2.0 ** 63 * (1 - 1e-9):
        raise OverflowError("scores of these vectors do not fit a long")
    kind = np.float32 if bound < 2 ** 22 else np.float64
    whole = bound < 2 ** 52  # otherwise products are taken in 64-bit integers, and bounds are widened
    lists = np.sort(x, axis=0)
    sides = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1)
    own = [np.searchsorted(vec_ids, query_ids, s) for s in ("left", "right")]
    found = ([], [], [])
    for lo in range(0, len(q), QUERY_STEP):
        step = sides[lo: lo + QUERY_STEP].astype(kind)
        n = len(step)
        alive = np.ones((n, m), bool)
        for i in range(n):
            alive[i, own[0][lo + i]: own[1][lo + i]] = False
        cols = np.arange(m)
        for share in rounds:
            read = int(share * m)
            if not whole or read <= k or len(cols) <= k:
                break
            top, low = lists[m - read], lists[read - 1]  # reading fronts from either end
            v = x[cols]
            upper = step @ np.concatenate([np.maximum(v, top), np.minimum(v, low)], 1).astype(kind).T
            lower = step @ np.concatenate([np.where(v >= top, v, lists[0]), np.where(v <= low, v, lists[-1])], 1).astype(kind).T
            lower[~alive[:, cols]] = -np.inf
            best = np.partition(lower, len(cols) - k, axis=1)[:, len(cols) - k]
            alive[:, cols] &= upper >= best[:, None]
            cols = np.flatnonzero(alive.any(0))
        if whole:
            score = (q[lo: lo + QUERY_STEP].astype(kind) @ x[cols].astype(kind).T).astype(np.int64)
        else:
            score = q[lo: lo + QUERY_STEP].astype(np.int64) @ x[cols].astype(np.int64).T
        score[~alive[:, cols]] = np.iinfo(np.int64).min  # below any score that passed the bound
        take = min(k, len(cols))
        if not take:
            continue
        least = np.partition(score, len(cols) - take, axis=1)[:, len(cols) - take, None]
        r, c = np.nonzero((score >= least) & alive[:, cols])  # with all that tie with the last
        s = score[r, c]
        order = np.lexsort((c, ~s, r))  # ~s falls as s rises and cannot overflow
        r, c, s = r[order], c[order], s[order]
        best = np.arange(len(r)) - np.searchsorted(r, r) < take
        r, c = r[best], c[best]
        found[0].append(r + lo)
        found[1].append(by[cols[c]])
        found[2].append(s[best])
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of ``vectors`` for each row of
    ``queries`` (same columns), by inner product of floor(64 * component).

    Vectors that are null or hold a null or a component that is not finite take no part, nor do null
    ids.  Every row is a candidate, also repeated ones; rows that share the query's id are the query's
    own.  Vectors of unequal length are compared as if the shorter ended in zeros."""
    def ready(df):
        bad = F.exists(F.col("v"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        df = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return df.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)

    x, q = ready(vectors), ready(queries)
    n, width = x.agg(F.count("*"), F.max(F.size("v"))).first()
    nq, q_width = q.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, q_width or 0)
    n_blocks, q_blocks = max(1, math.ceil(n / VECTOR_BLOCK)), max(1, math.ceil(nq / QUERY_BLOCK))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    x = x.withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int")).withColumn("qb", every(q_blocks))
    q = q.withColumn("qb", F.pmod(F.xxhash64("id", "v"), F.lit(q_blocks)).cast("int")).withColumn("b", every(n_blocks))

    def pair(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        q_ids, ids = left["id"].to_numpy(), right["id"].to_numpy()
        r, c, score = block_top(q_ids, matrix(left["v"], width), ids, matrix(right["v"], width), k)
        return pa.table({"query_id": q_ids[r], "vec_id": ids[c], "score": score})

    ship(vectors.sparkSession)
    best = q.groupBy("b", "qb").cogroup(x.groupBy("b", "qb")).applyInArrow(pair, RESULT)
    w = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
