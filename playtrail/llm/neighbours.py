"""Nearest vectors by cosine: int8 product tiles with error bounds, exact recomputation, merging by heaps.

Queries and candidates are cut into blocks by a hash of the key; every pair of blocks is one group and at most a few MB.
A unit vector x is s*q + r with q in int8, so x.y lies within |r_x| + |r_y| + |r_x||r_y| of s_x*s_y*(q_x.q_y). Integer
products are exact in float32 up to 1040 components (float64 beyond). A pair survives when its upper bound reaches the
k-th largest lower bound of its query; survivors are recomputed in float64 from the given vectors, and a heap per query
keeps the best. Equal vectors of a block are scored once and their ids expanded afterwards: a group of copies costs one
row. The bounds leave nothing out, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 8192  # rows of a block
TILE = 512  # queries of one product
SLACK = 1e-6  # above the rounding of float32 products


def usable(vec: str | Column) -> Column:
    """True for vectors with components, all present and finite, and not all zero."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def quantised(unit: np.ndarray):
    """Per row: int8 codes (held as floats for the product), scale, and the length of what the codes leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    left = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1))
    kind = np.float32 if unit.shape[1] <= 1040 else np.float64
    return codes.astype(np.int8).astype(kind), scale, left


def distinct_vectors(ids: np.ndarray, rows: np.ndarray, keep: int | None):
    """Distinct rows and, for each, its distinct ids in order (the first `keep`: of equal scores only those can win)."""
    flat = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1])))[:, 0]
    _, first, group = np.unique(flat, return_index=True, return_inverse=True)
    order = np.lexsort((ids, group))
    bounds = np.flatnonzero(np.diff(group[order], prepend=-1, append=len(first)))
    return rows[first], [np.unique(ids[order[a:b]])[:keep] for a, b in zip(bounds[:-1], bounds[1:])]


def best_pairs(query_ids, queries, cand_ids, cands, k: int):
    """(query, candidate, cosine) of each query's k best candidates with another id."""
    q_rows, q_groups = distinct_vectors(query_ids, queries, None)
    c_rows, c_groups = distinct_vectors(cand_ids, cands, k + 1)
    q_norm, c_norm = np.sqrt((q_rows * q_rows).sum(axis=1)), np.sqrt((c_rows * c_rows).sum(axis=1))
    q_code, q_scale, q_left = quantised(q_rows / q_norm[:, None])
    c_code, c_scale, c_left = quantised(c_rows / c_norm[:, None])
    alone = {g[0]: i for i, g in enumerate(c_groups) if len(g) == 1}  # the only row of its vector
    for start in range(0, len(q_rows), TILE):
        part = slice(start, start + TILE)
        approx = (q_code[part] @ c_code.T) * (q_scale[part, None] * c_scale[None])
        error = q_left[part, None] + c_left[None] + q_left[part, None] * c_left[None] + SLACK
        lower = approx - error
        for i, group in enumerate(q_groups[part]):
            if len(group) == 1 and group[0] in alone:
                lower[i, alone[group[0]]] = -np.inf
        floor = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(lower), -np.inf)
        alive = approx + error >= floor[:, None]
        for i, group in enumerate(q_groups[part]):
            near = np.flatnonzero(alive[i])
            row = q_rows[start + i]
            score = (c_rows[near] * row).sum(axis=1) / (c_norm[near] * q_norm[start + i])
            best = heapq.nsmallest(k + 1, ((-s, int(c)) for j, s in zip(near, score.tolist()) for c in c_groups[j]))
            for query in group.tolist():
                yield from ((query, c, -s) for s, c in [p for p in best if p[1] != query][:k])


def matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def nearest(queries: DataFrame, candidates: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 5) -> DataFrame:
    """query_id, rank from 1, vec_id, score: each query's k candidates of largest cosine, ties to the smaller id.

    Candidates are all rows with another id; with fewer than k of them, all. Vectors that are null, empty, all zero or
    hold null or non-finite components, and rows with a null key, take no part; only vectors of one length are
    compared. Rows alike in id and vector count once. Other columns are not read; empty tables give no rows.
    """
    def ready(df):
        return df.where(F.col(key).isNotNull() & usable(vec)).select(
            F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), F.size(vec).alias("dim"))

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            found = list(best_pairs(left.column("id").to_numpy(), matrix(left.column("v"), dim),
                                    right.column("id").to_numpy(), matrix(right.column("v"), dim), k))
        return pa.Table.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(schema.types)], schema=schema)

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    q_blocks, c_blocks = (max(1, -(-df.count() // BLOCK)) for df in (queries, candidates))

    def block(n):
        return F.pmod(F.xxhash64("id"), F.lit(n))

    left = (ready(queries).withColumn("qb", block(q_blocks))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)).cast("array<bigint>"))))
    right = (ready(candidates).withColumn("cb", block(c_blocks))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<bigint>"))))
    group = ("dim", "qb", "cb")
    found = (left.groupBy(*group).cogroup(right.groupBy(*group))
             .applyInArrow(lambda a, b: pairs(a, b), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5"""
