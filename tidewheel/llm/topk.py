"""Exact top-k by inner product with a vector-approximation file.

Vectors are whole numbers floor(scale * x).  Each has a coarse twin, one byte a component: the cell it lies in.  A
scan of the cells bounds every score from both sides; exact vectors are read from the highest upper bound down until
the k-th score found exceeds all bounds left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors and queries of one task: block by block, so memory is bounded whatever the table holds.
VECTORS, QUERIES, READ = 16_384, 2_048, 64


def whole(df: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v`` (array<bigint>) of the vectors that take part: not null or empty, all components finite."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    ok = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(x, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return df.where(F.col("vec_id").isNotNull() & ok).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("bigint")).alias("v"))


def cells(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte cells of the rows and, per component, the cells' low edge and width."""
    low, high = v.min(0), v.max(0)
    width = (high - low) // 256 + 1
    return ((v - low) // width).astype(np.uint8), low, width


def search(ids: np.ndarray, v: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``query, vector, score`` of each query's k best of ``v`` but itself, ties to the smaller id.

    Bounds are exact in doubles while scores stay below 2**51.  Beyond that all rows are scored in whole numbers of any
    size; a score that a long cannot hold is given as the nearest long, ranked by its true value.
    """
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    exact = float(np.abs(v).max()) * float(np.abs(q).max()) * v.shape[1] < 2.0 ** 51
    code, low, width = cells(v)
    mid, half = code.astype(np.float64) * width + low + (width - 1) / 2, (width - 1) / 2
    out = []
    for lo in range(0, len(q), 128):
        part = q[lo:lo + 128].astype(np.float64)
        centre, slack = part @ mid.T if exact else None, np.abs(part) @ half
        for n in range(len(part)):
            me, mine = qids[lo + n], q[lo + n]
            if not exact:
                score, rows = v.astype(object) @ mine.astype(object), np.flatnonzero(ids != me)
            else:
                upper = centre[n] + slack[n]
                upper[ids == me] = -np.inf
                # k rows reach their lower bounds, so nothing whose upper bound is below the k-th of these counts.
                floor = np.partition(upper, -k)[-k] - 2 * slack[n] if len(ids) > k else -np.inf
                look = np.flatnonzero((upper >= floor) & (upper > -np.inf))
                look = look[np.argsort(-upper[look], kind="stable")]
                rows, score, kth = np.empty(0, np.int64), np.zeros(len(ids), np.int64), -np.inf
                for at in range(0, len(look), READ):
                    if len(rows) >= k and upper[look[at]] < kth:
                        break
                    new = look[at:at + READ]
                    score[new] = v[new] @ mine
                    rows = np.concatenate([rows, new])
                    if len(rows) >= k:
                        kth = np.partition(score[rows], -k)[-k]
            best = sorted(rows.tolist(), key=lambda r: (-score[r], ids[r]))[:k]
            out += [(int(me), int(ids[r]), int(score[r])) for r in best]
    return out


def top_k(df: DataFrame, *, k: int = 10, every: int = 100, scale: int = 1024, vectors: int = VECTORS, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of every row whose ``vec_id`` is divisible by ``every``.

    All other rows are candidates, all of them if fewer than k; ties go to the smaller ``vec_id``.  Vectors that are null,
    empty or hold null or non-finite components take no part, nor do null ids; vectors of different length are not
    compared; a repeated ``vec_id`` takes part once, by its smallest vector.  Queries in blocks meet vectors in
    blocks; a pair of blocks gives k rows a query at most.
    """
    v = whole(df, scale).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n = v.count()
    nv, nq = max(1, -(-n // vectors)), max(1, -(-n // every // queries))
    block = lambda of, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(of)).cast("int")
    right = v.withColumn("vb", block(nv, 1)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    left = v.where(F.col("vec_id") % every == 0).withColumn("qb", block(nq, 2)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1))))

    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        got = search(x["vec_id"].to_numpy(), np.stack(x["v"].to_numpy()), q["vec_id"].to_numpy(), np.stack(q["v"].to_numpy()), k) if len(q) and len(x) else []
        # The true score in two longs, so that blocks' results merge in its order whatever its size.
        full = [(a, b, max(-(1 << 63), min((1 << 63) - 1, s)), s >> 62, s & ((1 << 62) - 1)) for a, b, s in got]
        full = [(a, b, s, max(-(1 << 63), min((1 << 63) - 1, h)), lo) for a, b, s, h, lo in full]
        return pd.DataFrame(full, columns=["query_id", "vec_id", "score", "high", "low"], dtype="int64")

    found = left.groupBy("dim", "qb", "vb").cogroup(right.groupBy("dim", "qb", "vb")).applyInPandas(run, "query_id bigint, vec_id bigint, score bigint, high bigint, low bigint")
    w = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
