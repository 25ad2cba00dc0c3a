"""Approximate nearest neighbours by cosine: an inverted file with an adaptive dimension scan.

Vectors are brought to length one, turned by a random rotation and dealt to the list of
their nearest centre. A query looks into a share of the lists that hold a vector, nearest
first, and into further ones until they hold ``k`` vectors besides itself. The number of lists, up to the root of the
number of vectors, and that share are chosen by what finds the neighbours of held-out vectors of the sample at least cost. There, candidates lie in
column blocks: after each block of dimensions the partial squared distances are put to a
hypothesis test, and a candidate whose distance, estimated from the dimensions seen, is
too far beyond the query's present k-th is abandoned. Whoever survives all dimensions is
scored exactly, in double precision on the original vectors.

Centres are fitted on a bounded sample and drawn from its distinct vectors; every vector is indexed. A list is scanned in
groups of bounded numbers of candidates and queries, chosen by hash, so a list with a
third of all vectors is many groups. Vectors that are null, of length zero, or that hold
a null or non-finite component take no part, nor do those whose number of components is
not the most frequent one. Repeated vectors are neighbours of each other like any others;
ties go to the smaller ``vec_id``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import arrow_batch, written

#: The fewest and the most lists that are tried, and vectors that the centres are fitted on.
LEAST_LISTS, MOST_LISTS, SAMPLED = 64, 1024, 16_384
#: Share of the true neighbours of held-out vectors of the sample that must lie in the lists looked into, and how many are held out.
RECALL, HELD_OUT = 0.97, 256
#: What one more list looked into costs a query, in distances.
LIST_COST = 50
#: Candidates and queries of one group.
CANDIDATES, QUERIES = 8_192, 1_024
#: Dimensions of a column block, and how far a candidate must be beyond the k-th to be abandoned.
COLUMNS, CONFIDENCE = 8, 2.4


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.float64)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotation(size: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _sound(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(_sound(F.col("vector")))
    )


def centres(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Spherical k-means of unit vectors; no two centres begin at copies of one vector."""
    rng = np.random.default_rng(seed)
    distinct = np.sort(np.unique(sample.round(9), axis=0, return_index=True)[1])
    found = sample[rng.choice(distinct, min(lists, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        nearest = (sample @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        some = np.bincount(nearest, minlength=len(found)) > 0
        found[some] = sums[some]
        found /= np.linalg.norm(found, axis=1, keepdims=True)
    return found


def lists_to_probe(sample: np.ndarray, found: np.ndarray, k: int) -> int:
    """Nearest lists of ``found`` in which ``RECALL`` of the ``k`` nearest of held-out vectors lie.

    Measured inside the sample, where neighbours are farther apart than among all vectors, so
    it asks for more lists than all vectors do.
    """
    held = np.arange(0, len(sample), max(1, len(sample) // HELD_OUT))
    near = sample[held] @ sample.T
    near[np.arange(len(held)), held] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(found)
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(sample[held] @ found.T), axis=1, kind="stable"), axis=1)
    own = (sample @ found.T).argmax(axis=1)
    ranks = np.sort(np.take_along_axis(place, own[true], axis=1), axis=None)
    return int(ranks[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))) - 1)]) + 1


def fitted_lists(sample: np.ndarray, total: int, k: int, lists: int | None) -> tuple[np.ndarray, float]:
    """Centres and the share of lists to look into, of the number of lists that costs a query least.

    Tried are ``LEAST_LISTS`` and its doubles up to the root of ``total``: vectors with structure gain by
    many small lists, vectors without it only pay for them.
    """
    upto = min(MOST_LISTS, max(LEAST_LISTS, int(np.sqrt(total))), max(LEAST_LISTS, len(sample) // 16))
    tried = [lists] if lists else sorted({min(LEAST_LISTS << i, upto) for i in range(upto.bit_length())})
    best: tuple = ()
    for n in tried:
        found = centres(sample, n)
        many = lists_to_probe(sample, found, k)
        cost = total * many / len(found) + LIST_COST * many + len(found)
        if not best or cost < best[0]:
            best = cost, found, many / len(found)
    return best[1:]


def scan(query: np.ndarray, blocks: list[np.ndarray], k: int, skip: int) -> np.ndarray:
    """Candidates that outlive every test, and ``k`` at least, by squared distance of unit vectors.

    ``blocks``: column blocks of the candidates; ``skip``: the query's own place, or -1.
    """
    n, size = len(blocks[0]), len(query)
    alive = np.arange(n) if skip < 0 else np.delete(np.arange(n), skip)
    partial = ((blocks[0][alive] - query[: blocks[0].shape[1]]) ** 2).sum(axis=1)
    best = alive[np.argpartition(partial, k - 1)[:k]] if len(alive) > k else alive
    at, whole = 0, np.zeros(len(best))
    for block in blocks:
        whole += ((block[best] - query[at : at + block.shape[1]]) ** 2).sum(axis=1)
        at += block.shape[1]
    if len(alive) <= k:
        return alive
    kth = float(whole.max())
    at = blocks[0].shape[1]
    for block in blocks[1:]:
        bound = kth * at / size * (1 + CONFIDENCE / np.sqrt(at)) ** 2 + 1e-6
        live = partial <= bound
        alive, partial = alive[live], partial[live]
        partial = partial + ((block[alive] - query[at : at + block.shape[1]]) ** 2).sum(axis=1)
        at += block.shape[1]
    return np.union1d(alive[partial <= kth + 1e-5], best)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    lists: int | None = None,
    probed: float | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every query row.

    ``is_query`` is a condition on the key, given as column ``vec_id``. ``lists`` and ``probed``, the share of
    lists that are looked into, are measured on the sample where they are not given.
    """
    spark = vectors.sparkSession
    sound = usable(vectors, key, vector)
    sizes = sound.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size")
    first = sizes.first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = first["size"], first["n"]
    sound = sound.where(F.size("vector") == size)
    share = F.lit(min(1.0, SAMPLED / first["n"]) * (1 << 20))
    sampled = sound.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).select("vec_id", "vector")
    turn = rotation(size)

    def fit(group: pa.Table) -> pa.Table:
        sample = _unit(_rows(group.sort_by("vec_id").column("vector"))) @ turn
        found, share = fitted_lists(sample, total, k, lists)
        return pa.table({"centre": pa.array(list(found), pa.list_(pa.float64())), "share": pa.array([share] * len(found))})

    rows = (
        sampled.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fit, "centre array<double>, share double").collect()
        or [[v, 1.0] for v in (_unit(np.array([sound.first()["vector"]])) @ turn).tolist()]
    )
    if probed is None:
        probed = rows[0][1]
    fitted = spark.sparkContext.broadcast(np.array([r[0] for r in rows]))

    def own_list(near: np.ndarray) -> np.ndarray:
        return near.argmax(axis=1)[:, None] == np.arange(near.shape[1])

    def deal(chosen: Callable[[np.ndarray], np.ndarray]):
        """``chosen``: which lists a row goes to, from its closeness to every centre."""
        schema = pa.schema(
            [("list", pa.int32()), ("vec_id", pa.int64()), ("turned", pa.binary()), ("vector", pa.list_(pa.float64()))]
        )

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                turned = _unit(_rows(batch.column(1))) @ turn
                each, lists_of = np.nonzero(chosen(turned @ fitted.value.T))
                raw = [t.tobytes() for t in turned.astype("<f4")]
                yield arrow_batch(
                    schema,
                    {
                        "list": lists_of.astype(np.int32),
                        "vec_id": batch.column(0).to_numpy()[each],
                        "turned": [raw[i] for i in each],
                        "vector": batch.column(1).take(pa.array(each)),
                    },
                )

        return lambda df: df.mapInArrow(assign, "list int, vec_id long, turned binary, vector array<double>")

    base = written(deal(own_list)(sound), "vector-lists")
    held = np.zeros(len(rows), dtype=np.int64)  # one number for each list
    for r in base.groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    many = max(1, int(np.ceil(probed * (held > 0).sum())))

    def near_lists(near: np.ndarray) -> np.ndarray:
        order = np.argsort(np.where(held > 0, -near, np.inf), axis=1, kind="stable")
        short = (held[order].cumsum(axis=1) <= k).sum(axis=1)  # the query itself is among the vectors held
        taken = np.zeros(near.shape, dtype=bool)
        np.put_along_axis(taken, order, np.arange(len(held)) < np.maximum(many, short + 1)[:, None], axis=1)
        return taken & (held > 0)

    asked = written(deal(near_lists)(sound.where(is_query)), "vector-queries")

    def blocks(df: DataFrame, bound: int, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count("*") / F.lit(bound)).cast("int").alias(name))

    # One row for each list: how many groups its candidates and its queries make.
    shape = F.broadcast(
        blocks(base, CANDIDATES, "cs").join(blocks(asked, QUERIES, "qs"), "list")
    )
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = base.join(shape, "list").withColumns({"c": own("cs")}).withColumn("q", every("qs")).drop("cs", "qs")
    right = asked.join(shape, "list").withColumns({"q": own("qs")}).withColumn("c", every("cs")).drop("cs", "qs")
    out_schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and queries.num_rows:
            ids, turned, original = _block(candidates, size)
            columns = [np.ascontiguousarray(turned[:, i : i + COLUMNS]) for i in range(0, size, COLUMNS)]
            norms = np.sqrt((original * original).sum(axis=1))
            place = {int(v): i for i, v in enumerate(ids)}
            for vec, q, exact in zip(*_block(queries, size), strict=True):
                found = scan(q, columns, k, place.get(int(vec), -1))
                if not len(found):
                    continue
                score = (original[found] * exact).sum(axis=1) / (norms[found] * np.sqrt((exact * exact).sum()))
                best = np.lexsort((ids[found], -score))[:k]
                out["query_id"].extend([int(vec)] * len(best))
                out["vec_id"].extend(ids[found[best]])
                out["score"].extend(score[best])
        return pa.Table.from_batches([arrow_batch(out_schema, out)])

    found = (
        left.groupBy("list", "c", "q")
        .cogroup(right.groupBy("list", "c", "q"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _block(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    turned = np.frombuffer(b"".join(table.column("turned").to_pylist()), dtype="<f4").reshape(-1, size)
    return table.column("vec_id").to_numpy(), turned, _rows(table.column("vector"))
