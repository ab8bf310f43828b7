"""Exact top-k search by no-random-access aggregation (operator 8)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

K = 10
BLOCK = 4_096          # candidates of a block, on average
QUERY_BLOCK = 1_024    # queries of a block, on average
# Parts of every list that have been read after each round.
ROUNDS = (0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 1.0)

FOUND = "query_id long, vec_id long, score long"


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, as doubles, which hold sums up to 2**53 exactly."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
                 queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids of one block for each query: numbers of queries and candidates, scores.

    Of several candidates under one id the best counts, so the k bounds and the k best are those
    of different ids.

    Every component has a list of the block's candidates, sorted by it. For one query the score
    is a sum of one term per list, and the list is read from the end where its term is
    greatest. After a round, a candidate's terms that were read are known; an unread term is at
    most that of the list's last entry read, and at least that of its far end. A query is done
    when no candidate outside its k best lower bounds can reach the k-th of them; exact scores
    then come from the terms that are left of those that can.
    """
    n = len(vectors)
    by_id = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[0]] - 1))
    order = np.argsort(vectors, axis=0, kind="stable")
    lists = np.take_along_axis(vectors, order, axis=0)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    open_queries = np.arange(len(query_ids))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for part in ROUNDS:
        if not len(open_queries):
            break
        depth = min(n, max(1, int(np.ceil(part * n))))
        up = np.maximum(queries[open_queries], 0).T     # lists read from the top
        down = np.minimum(queries[open_queries], 0).T   # lists read from the bottom
        top, bottom = rank >= n - depth, rank < depth
        known = (vectors * top) @ up + (vectors * bottom) @ down
        upper = known + ~top @ (up * lists[n - depth][:, None]) + ~bottom @ (down * lists[depth - 1][:, None])
        lower = known + ~top @ (up * lists[0][:, None]) + ~bottom @ (down * lists[-1][:, None])
        own = ids[:, None] == query_ids[open_queries][None, :]
        upper[own] = -np.inf
        lower[own] = -np.inf
        if len(first) < n:
            lower = np.maximum.reduceat(lower[by_id], first, axis=0)
        rest = len(first) - k
        bar = np.partition(lower, rest, axis=0)[rest] if rest > 0 else np.full(len(open_queries), -np.inf)
        able = (upper >= bar[None, :]) & (upper > -np.inf)
        counts = able.sum(axis=0)
        done = (counts <= max(4 * k, n // 64)) | (depth == n)
        for i in np.flatnonzero(done):
            rows = np.flatnonzero(able[:, i])
            scores = vectors[rows] @ queries[open_queries[i]]
            best = np.lexsort((ids[rows], -scores))
            best = best[np.sort(np.unique(ids[rows[best]], return_index=True)[1])[:k]]
            found.append((np.full(len(best), open_queries[i]), rows[best], scores[best]))
        open_queries = open_queries[~done]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` candidates of highest inner product for every query.

    Both tables have ``vec_id`` and ``vector``, an array of longs. Candidates and queries are
    dealt into blocks of bounded size by a hash of the whole row, and each pair of blocks is searched by itself;
    the best of all blocks are then ranked per query, cut to k before the shuffle.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; fewer than k if
    there are fewer. A row is never a candidate for its own vec_id. Null ids, null vectors and
    vectors with null elements take no part. Repeated rows count once; of several vectors under
    one vec_id the best score counts. Shorter vectors count as padded with zeros. Inner products
    must stay below 2**53. Other columns are ignored.
    """
    rows = [_valid(candidates), _valid(queries)]
    counted = [df.agg(F.count("*"), F.max(F.size("vector"))).first() for df in rows]
    n_blocks, n_query_blocks = (max(1, -(-c[0] // size)) for c, size in zip(counted, (block, query_block)))
    width = max([1] + [c[1] for c in counted if c[1]])
    number = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows[0].withColumn("block", number(n_blocks)).withColumn("query_block", spread(n_query_blocks))
    right = rows[1].withColumn("query_block", number(n_query_blocks)).withColumn("block", spread(n_blocks))

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        ids = own.column("vec_id").to_numpy()
        query_ids = asked.column("vec_id").to_numpy()
        query, candidate, score = search_block(
            ids, _matrix(own.column("vector"), width), query_ids,
            _matrix(asked.column("vector"), width), k)
        return pa.table({"query_id": query_ids[query.astype(np.int64)],
                         "vec_id": ids[candidate.astype(np.int64)],
                         "score": score.astype(np.int64)})

    keys = ["block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _valid(df: DataFrame) -> DataFrame:
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"),
                      F.col("vector").cast("array<long>").alias("vector"))
            .filter("vec_id is not null and vector is not null")
            .filter(~F.exists("vector", lambda x: x.isNull())).distinct())


def whole_numbers(embedding, scale: int = 1024):
    """Components x as floor(scale * x). Null if one is null or not finite."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    fit = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x)
                   & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fit, F.transform(F.when(fit, wide), lambda x: F.floor(x * scale)))
