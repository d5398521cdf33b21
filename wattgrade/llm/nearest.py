"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, survivors in double precision."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrade.llm.vectors import clean_vectors, pack, unpack
from wattgrade.session import staged

FOUND = "query_id long, vec_id long, score double"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale, norm of the row, norm of the rounding error), so that x is scale * int8 + error."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = x - q * scale[:, None]
    norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
    return q, scale, norm(x), norm(error)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows. Up to 1,040 dimensions every sum fits a float's 24 bits."""
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return q.astype(kind) @ c.astype(kind).T


def best_of(
    queries: np.ndarray, query_ids: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray, strip: int = 256
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (scores, ids) of its k best ids in a block, best first, by exact inner product.

    ``ids`` ascend; of several vectors of one id the best counts, so they never take the places of other ids.
    ``floor`` is a score that a neighbour must reach, known from earlier blocks. The approximate product and the
    norms of the rounding errors enclose the exact one: a candidate whose upper bound is under the k-th lower bound
    cannot be among the best.
    """
    cq, cs, cn, ce = quantised(block)
    first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1)) if len(ids) else np.zeros(0, np.int64)
    out = []
    for start in range(0, len(queries), strip):
        x = queries[start : start + strip]
        qq, qs, qn, qe = quantised(x)
        near = products(qq, cq).astype(np.float64) * qs[:, None] * cs[None, :]
        # |x.y - near| <= |ex||y| + |x - ex||ey| and |x - ex| <= |x| + |ex|
        slack = qe[:, None] * cn[None, :] + (qn + qe)[:, None] * ce[None, :]
        slack += 1e-12 * (qn[:, None] * cn[None, :])
        own = query_ids[start : start + strip, None] == ids[None, :]
        low = np.where(own, -np.inf, near - slack)
        if len(first) < len(ids):
            low = np.maximum.reduceat(low, first, axis=1)
        kth = np.partition(low, -k, axis=1)[:, -k] if len(first) > k else np.full(len(x), -np.inf)
        reach = np.maximum(kth, floor[start : start + strip])
        alive = (near + slack >= reach[:, None]) & ~own
        for r in range(len(x)):
            at = np.flatnonzero(alive[r])
            score = (block[at] * x[r]).sum(axis=1)
            order = np.lexsort((ids[at], -score))
            if len(first) < len(ids):
                order = order[np.sort(np.unique(ids[at[order]], return_index=True)[1])]
            out.append((score[order[:k]], ids[at[order[:k]]]))
    return out


def distinct_best(ordered: Iterable[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The first k entries of different ids."""
    out: list[tuple[float, int]] = []
    seen: set[int] = set()
    for entry in ordered:
        if entry[1] not in seen:
            seen.add(entry[1])
            out.append(entry)
            if len(out) == k:
                break
    return out


def search(
    df: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 20,
    query_rows: int = 1024,
    block_rows: int = 4096,
    blocks_per_task: int = 4,
) -> DataFrame:
    """The k nearest rows by inner product of every query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id`` (the vector's id). Every query is compared with all rows but
    those of its own id, best score first, ties to the smaller id; with fewer than k candidates all of them come.
    Queries and rows are packed into blocks, and a task takes one block of queries and some blocks of rows.

    Vectors that are null, zero or not finite, and rows without id, take no part. Vectors of different lengths are not
    compared; each length is searched by itself. Rows with equal id and vector count as one; of several vectors of one id
    the best counts. Without queries the result is empty.
    """
    out = "query_id long, rank int, vec_id long, score double"
    rows, dimensions = clean_vectors(df, vec_id, embedding)
    found = None
    for dimension in dimensions:
        one = _search_length(rows.where(F.size("v") == dimension), is_query, k, query_rows, block_rows, blocks_per_task)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        return df.sparkSession.createDataFrame([], out)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_length(
    rows: DataFrame, is_query: Column, k: int, query_rows: int, block_rows: int, blocks_per_task: int
) -> DataFrame | None:
    """(query_id, vec_id, score) among (id, v) of one length, with the k best ids of each query in it; None without
    queries."""
    rows = staged(rows.distinct(), "search-vectors")
    sizes = rows.agg(F.count("*").alias("rows"), F.count(F.when(is_query, 1)).alias("queries")).first()
    if not sizes["queries"]:
        return None
    spread = F.xxhash64("id", "v")
    n_queries, n_blocks = -(-sizes["queries"] // query_rows), -(-sizes["rows"] // block_rows)
    queries = pack(rows.where(is_query).withColumn("block", F.pmod(spread, F.lit(n_queries))), "block")
    blocks = pack(rows.withColumn("block", F.pmod(spread, F.lit(n_blocks))), "block")
    queries, blocks = staged(queries, "query-blocks"), staged(blocks, "row-blocks")
    n_tasks = -(-n_blocks // blocks_per_task)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # A stated query set against all rows: each block of one side goes to the tasks of the other side's blocks.
    asked = queries.select(F.col("block").alias("q"), every(n_tasks).alias("task"), F.lit(True).alias("asks"), "ids", "data")
    given = blocks.select(every(n_queries).alias("q"), F.pmod("block", F.lit(n_tasks)).alias("task"), "ids", "data")
    work = asked.unionByName(given.withColumn("asks", F.lit(False)))

    def answer(key: tuple, group: pa.Table) -> pa.Table:
        asks = group["asks"].to_pylist()
        parts = [unpack(i.as_py(), d.as_py()) for i, d in zip(group["ids"], group["data"], strict=True)]
        asking = [p for p, a in zip(parts, asks, strict=True) if a]
        if not asking:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        query_ids, queries_ = asking[0]
        best: list[list[tuple[float, int]]] = [[] for _ in query_ids]
        floor = np.full(len(query_ids), -np.inf)
        for (ids, block), a in zip(parts, asks, strict=True):
            if a:
                continue
            for r, (score, found) in enumerate(best_of(queries_, query_ids, block, ids, k, floor)):
                new = list(zip((-score).tolist(), found.tolist(), strict=True))
                best[r] = distinct_best(heapq.merge(best[r], new), k)
                if len(best[r]) == k:
                    floor[r] = -best[r][-1][0]
        flat = [(int(q), i, -s) for q, found in zip(query_ids, best, strict=True) for s, i in found]
        return pa.table(
            {
                "query_id": pa.array([x[0] for x in flat], pa.int64()),
                "vec_id": pa.array([x[1] for x in flat], pa.int64()),
                "score": pa.array([x[2] for x in flat], pa.float64()),
            }
        )

    return work.groupBy("q", "task").applyInArrow(answer, FOUND)
