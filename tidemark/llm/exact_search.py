"""Exact search for the largest inner products by multi-resolution segment statistics.

A vector's components become whole numbers, floor(scale * x). At each resolution a vector is
cut into segments, and a segment is told by its mean and deviation. For two vectors the
squared distance is at least the sum over segments of m ((mean - mean')^2 + (dev - dev')^2),
so with |q|^2 + |x|^2 - 2 q.x for the distance, the inner product is at most the sum of
m (mean mean' + dev dev'). Going from one segment to segments of two components, candidates whose
bound is below the query's k-th best score so far are left; the survivors are scored
exactly in integers.

Candidates and queries lie in blocks of bounded numbers, dealt by hash of a row number, so
copies spread evenly; a pair of blocks is one group of a cogroup. The first block of candidates
is searched first: its k-th best scores are the thresholds with which the other blocks begin.

Vectors that are null or hold a null or non-finite component take no part; zero vectors do. Vectors of
different lengths are no candidates of each other; vectors without components have score 0.
An id stands for all its rows: no row with the query's id is its candidate, a pair of ids has the best
score of its rows, and is ranked once. Equal scores go to the smaller id. An empty table, or a single id,
gives no rows. Scores must fit into 64 bits. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import arrow_batch, written

#: Candidates and queries of one block; queries whose bounds are held at a time; pairs scored at a time.
CANDIDATES, QUERIES, TILE, PAIRS = 4_096, 4_096, 128, 16_384
#: Above this share of pairs still open, bounds are computed for all pairs of a tile in one product.
DENSE = 0.125

_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def resolutions(size: int) -> list[int]:
    """Numbers of segments, coarse to fine."""
    found, segments = [], 1
    while segments <= max(1, size // 2) and size:
        found.append(segments)
        segments *= 2
    return found


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Mean and deviation of every segment, times the root of its length: bounds are inner products of these."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    lengths, x = np.diff(edges), x.astype(np.float64)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / lengths
    spread = np.add.reduceat((x - np.repeat(mean, lengths, axis=1)) ** 2, edges[:-1], axis=1)
    return np.hstack([mean * np.sqrt(lengths), np.sqrt(spread)])


def _exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    out = np.empty(len(qi), dtype=np.int64)
    for at in range(0, len(qi), PAIRS):
        part = slice(at, at + PAIRS)
        out[part] = (q[qi[part]] * x[ci[part]]).sum(axis=1)
    return out


def _raise(q, x, bound: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """``least``, or the k-th best score of the k candidates of the highest bounds."""
    if bound.shape[1] < k:
        return least
    seeds = np.argpartition(bound, bound.shape[1] - k, axis=1)[:, -k:]
    rows = np.repeat(np.arange(len(q)), k)
    score = _exact(q, x, rows, seeds.ravel()).astype(np.float64).reshape(-1, k)
    score[np.take_along_axis(bound, seeds, axis=1) == -np.inf] = -np.inf  # own rows
    return np.maximum(least, score.min(axis=1))


def search_block(
    query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, ids and scores of each query's ``k`` best ids among these candidates.

    ``least``: a score that at least ``k`` ids elsewhere reach, or -inf; what is below may be left out.
    """
    levels = resolutions(x.shape[1])
    xs, qs = [statistics(x, s) for s in levels], [statistics(q, s) for s in levels]
    x_norm, q_norm = (np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)) for v in (x, q))
    single = len(np.unique(ids)) == len(ids)  # else k rows need not be k ids, and scores bound nothing
    parts: list[tuple] = []
    for at in range(0, len(q), TILE):
        here = slice(at, at + TILE)
        tile, floor = q[here], least[here].astype(np.float64)
        slack = 1e-9 * np.outer(q_norm[here], x_norm) + 0.5
        other = query_ids[here][:, None] != ids[None, :]
        alive = other.copy()
        for sq, sx in zip(qs, xs, strict=True):
            if alive.mean() > DENSE:
                bound = np.where(other, sq[here] @ sx.T + slack, -np.inf)
                if single:
                    floor = _raise(tile, x, bound, floor, k)
                alive &= bound >= floor[:, None]
            else:
                qi, ci = np.nonzero(alive)
                bound = np.einsum("ij,ij->i", sq[here][qi], sx[ci]) + slack[qi, ci]
                alive[qi, ci] = bound >= floor[qi]
        qi, ci = np.nonzero(alive)
        score = _exact(tile, x, qi, ci)
        order = np.lexsort((ids[ci], ~score, qi))  # ~ turns the order without overflow
        qi, ci, score = qi[order], ci[order], score[order]
        if not single:
            _, first = np.unique(np.stack([qi, ids[ci]]), axis=1, return_index=True)
            first.sort()
            qi, ci, score = qi[first], ci[first], score[first]
        starts = np.searchsorted(qi, qi)
        best = np.arange(len(qi)) - starts < k
        parts.append((query_ids[here][qi[best]], ids[ci[best]], score[best]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """vec_id, vector of whole numbers, of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("vector")
    )


def _by_size(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of vectors -> their places in the table, and the vectors."""
    column = table.column("vector").combine_chunks()
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = {}
    for size in np.unique(sizes):
        places = np.nonzero(sizes == size)[0]
        out[int(size)] = places, flat[starts[places][:, None] + np.arange(size)].reshape(len(places), size)
    return out


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of every query id.

    ``is_query`` is a condition on the key, given as column ``vec_id``.
    """
    numbered = whole_numbers(vectors, key, vector, scale).withColumn("row", F.monotonically_increasing_id())
    base = written(numbered, "whole-vectors")
    asked = base.where(is_query).toDF(*base.columns)  # columns of its own, as it meets ``base`` in a cogroup
    blocks = max(1, -(-base.count() // candidates))
    query_blocks = max(1, -(-asked.count() // queries))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda first, n: F.explode(F.sequence(F.lit(first), F.lit(n - 1)))

    def search(pair: pa.Table, other: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if pair.num_rows and other.num_rows:
            ids, mine = pair.column("vec_id").to_numpy(), _by_size(pair)
            query_ids, least = other.column("vec_id").to_numpy(), other.column("least").to_numpy()
            for size, (places, q) in _by_size(other).items():
                if size in mine:
                    at, x = mine[size]
                    found.append(search_block(query_ids[places], q, least[places], ids[at], x, k))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * 3
        return pa.Table.from_batches([arrow_batch(_OUT, dict(zip(_OUT.names, columns, strict=True)))])

    def searched(first: int, n: int, asked: DataFrame) -> DataFrame:
        """Candidates of the blocks from ``first`` to before ``n``."""
        left = base.withColumn("c", dealt(blocks)).where(F.col("c").between(first, n - 1))
        left = left.withColumn("q", every(0, query_blocks))
        right = asked.withColumn("q", dealt(query_blocks)).withColumn("c", every(first, n))
        pairs = left.groupBy("c", "q").cogroup(right.groupBy("c", "q"))
        return pairs.applyInArrow(search, "query_id long, vec_id long, score long")

    unbounded = F.lit(float("-inf"))
    found = written(searched(0, 1, asked.withColumn("least", unbounded)), "first-block")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if blocks > 1:
        # Rows of one query id may differ; a threshold must hold for the id, and that of its best rows does.
        pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        kth = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        kth = kth.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("kth"))
        told = asked.join(kth, "vec_id", "left").withColumn("least", F.coalesce("kth", unbounded)).drop("kth")
        found = found.unionByName(searched(1, blocks, told))
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = pairs.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
