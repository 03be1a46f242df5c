"""Exact nearest neighbours by a block matrix join.

Queries and candidates are cut into blocks, and each task multiplies one tile of the matrix of inner products. A tile is
first computed from int8 codes. The rest of each vector, which its code leaves out, has a known length, so every product
has an error bound; a pair survives if its upper bound reaches the tile's k-th largest lower bound. Survivors are
computed again from the original vectors in double precision, and the best of each tile are merged by heaps.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm.staging import staged

#: Vectors of a query block and of a candidate block.
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
#: Lists merged by one task of a merging round.
MERGE_LISTS = 64
#: float32 holds a sum of int8 products exactly up to this many dimensions; longer vectors are summed in float64.
EXACT_DIMENSIONS = (1 << 24) // 127**2


def usable(vector: str) -> Column:
    """True for vectors that are not null, empty or zero and hold finite components only."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, length of scale * code, length of the rest) of each row."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def tile_best(qi: np.ndarray, q: np.ndarray, ci: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, score) of the k best candidates of each query within one tile, a query itself left out."""
    qc, qs, ql, qr = quantised(q)
    cc, cs, cl, cr = quantised(c)
    exact = np.float32 if q.shape[1] <= EXACT_DIMENSIONS else np.float64
    product = (qc.astype(exact) @ cc.astype(exact).T).astype(np.float64) * qs[:, None] * cs[None, :]
    #: (a + r)(b + s) differs from ab by as + rb + rs at most; the last factor covers rounding
    bound = (ql[:, None] * cr[None, :] + qr[:, None] * (cl + cr)[None, :]) * (1 + 1e-9) + 1e-12 * (ql + qr)[:, None] * (cl + cr)[None, :]
    own = qi[:, None] == ci[None, :]
    low, high = np.where(own, -np.inf, product - bound), np.where(own, -np.inf, product + bound)
    out = []
    take = min(k, len(ci))
    floor = -np.partition(-low, take - 1, axis=1)[:, take - 1]
    for row in range(len(qi)):
        near = np.flatnonzero((high[row] >= floor[row]) & ~own[row])
        if len(near):
            score = (c[near] * q[row]).sum(axis=1)
            best = np.lexsort((ci[near], -score))[:k]
            out += zip([int(qi[row])] * len(best), ci[near][best].tolist(), score[best].tolist(), strict=True)
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


_FOUND = "query_id long, dim int, list int, vec_id long, score double"


def _rows(rows: list) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64())
    return pa.table([pa.array([r[j] for r in rows], kinds[j]) for j in range(5)], names=["query_id", "dim", "list", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product of each query, ties to smaller ids.

    Candidates are all usable vectors of the query's dimension but the query's own; fewer than k give all of them. Null
    ids, and vectors that usable() refuses, take no part. Of rows that repeat an id one, the least vector, counts.
    An empty table gives an empty result; other columns are ignored. Block counts follow the row counts, and a task
    holds one tile. Vectors of floats travel as floats, all others as doubles; both are multiplied in double precision.
    """
    kind = "array<float>" if isinstance(vectors.schema[vector].dataType.elementType, T.FloatType) else "array<double>"
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(vector)).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"), is_query.alias("q"))
    rows = rows.groupBy("id").agg(F.min(F.struct("v", "q")).alias("x")).select("id", "x.v", "x.q", F.size("x.v").alias("dim"))
    rows = staged(rows, "vectors")
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("nq")).first()
    nc, nq = max(1, math.ceil(count["n"] / CANDIDATE_BLOCK)), max(1, math.ceil(count["nq"] / QUERY_BLOCK))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where("q").select("id", "v", "dim", F.lit(True).alias("q"), own(nq).alias("qb")).select("*", every(nc).alias("cb"))
    candidates = rows.select("id", "v", "dim", F.lit(False).alias("q"), own(nc).alias("cb")).select("*", every(nq).alias("qb"))

    def tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, _, cb = (x.as_py() for x in key)
        table = table.combine_chunks()
        mask = table.column("q").to_numpy()
        ids = table.column("id").to_numpy()
        x = _matrix(table.column("v").combine_chunks(), dim)
        out: list = []
        if mask.any() and not mask.all():
            qi, q, ci, c = ids[mask], x[mask], ids[~mask], x[~mask]
            for lo in range(0, len(qi), 128):
                out += [(a, dim, cb // MERGE_LISTS, b, s) for a, b, s in tile_best(qi[lo : lo + 128], q[lo : lo + 128], ci, c, k)]
        return _rows(out)

    found = queries.unionByName(candidates).groupBy("dim", "qb", "cb").applyInArrow(tile, _FOUND)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = zip((-s for s in table.column("score").to_pylist()), table.column("vec_id").to_pylist(), strict=True)
        best = heapq.nsmallest(k, rows)
        query, dim, part = (x.as_py() for x in key)
        return _rows([(query, dim, part // MERGE_LISTS, b, -s) for s, b in best])

    lists = nc
    while lists > MERGE_LISTS:
        found = found.groupBy("query_id", "dim", "list").applyInArrow(merge, _FOUND)
        lists = -(-lists // MERGE_LISTS)

    def last(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = zip((-s for s in table.column("score").to_pylist()), table.column("vec_id").to_pylist(), strict=True)
        best = heapq.nsmallest(k, rows)
        return pa.table({"query_id": pa.array([key[0].as_py()] * len(best), pa.int64()), "rank": pa.array(range(1, len(best) + 1), pa.int32()), "vec_id": pa.array([b for _, b in best], pa.int64()), "score": pa.array([-s for s, _ in best], pa.float64())})

    return found.groupBy("query_id").applyInArrow(last, "query_id long, rank int, vec_id long, score double")
