"""Ranked lexical search by norm buckets: the largest inner products of impact vectors.

A document's impact vector has, for each term t of the items, the whole number
x_t = (10^9 tf) div (1000 tf + 8 m), where m grows with the document's length; an item's vector
has q_t = weight(t) times its occurrences in the item. The score is their inner product.

Documents are ordered by the length of their vectors and lie in buckets of near-equal length.
The longest ones are searched first; the k-th best score of each item found there is its threshold.
After that a bucket is left out for an item if the product of lengths, which the
inner product cannot exceed (Cauchy-Schwarz), is below the threshold; buckets too short for
every item are not read. Inside a bucket the item's terms are taken from the rarest on until what the
rest can add, by the largest coordinate of each in the bucket, is below the threshold: a
document without one of these terms cannot reach it. The others are bounded by their partial
product and the rest's product of lengths, and whoever survives is scored exactly in integers.
Thresholds rise as a task goes on.

Terms are runs of bytes that are no ASCII control, blank or punctuation, A-Z in lower case; a text without
one, or null, has no terms, is not counted, and scores nothing. Repeated rows of a document are
documents; a null id is ordered after all others. Rows of one item with equal texts are one item,
those with different texts make one item of all their terms; an item whose best score is 0 gives no rows,
as does an empty table. Texts of any length are read whole. Other columns than the named ones play no part.

Items go in blocks of a bounded number of terms (a single item is never split), each with a pass over the documents; what the driver holds is
one block's terms, weights and thresholds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import arrow_batch, shuffle_partitions, slices, text_bytes, written

#: Free parameters of the score.
SCALE, SATURATION, LENGTH_PERCENT = 1_000_000_000, 8, 75
#: Terms of a block of items; documents of a bucket; longest documents that give the first thresholds.
BLOCK_TERMS, BUCKET, SEEDS = 400_000, 2_048, 4_096

#: Bytes of a text as they count: blanks for what separates terms, A-Z in lower case.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_LAST = 2**63 - 1


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split()


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term, n) for every term of every item."""
    texts = items.select(F.col(item).alias("item"), text_bytes(text).alias("text")).distinct()
    kind = dict(texts.dtypes)["item"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = [Counter(terms_of(t)) for t in batch.column(1).to_pylist()]
            places = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
            yield pa.RecordBatch.from_pydict(
                {
                    "item": batch.column(0).take(pa.array(places)),
                    "term": pa.array([t for c in counts for t in c], pa.binary()),
                    "n": pa.array([n for c in counts for n in c.values()], pa.int64()),
                }
            )

    found = texts.mapInArrow(count, f"item {kind}, term binary, n long")
    return found.groupBy("item", "term").agg(F.sum("n").alias("n"))


def document_terms(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): a document's number of terms, and those of the vocabulary in ascending order."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in slices(batches):
            lengths, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                counts = sorted(Counter([number[w] for w in words if w in number]).items())
                lengths.append(len(words))
                terms.append([t for t, _ in counts])
                tfs.append([n for _, n in counts])
            yield arrow_batch(schema, {"doc_id": batch.column(0), "n": lengths, "terms": terms, "tf": tfs})

    wanted = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc_id"), text_bytes(text).alias("text"))
    return wanted.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<int>")


@dataclass
class Queries:
    """The items of a block: their terms and weights, rarest terms first, and the length of each."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]

    def lengths(self) -> np.ndarray:
        return np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in self.weights])


class Bucket:
    """Impact vectors of documents of near-equal length, by document and by term."""

    def __init__(self, ids: np.ndarray, terms: pa.ListArray, impacts: pa.ListArray):
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
        self.ids, self.starts = ids, np.concatenate([[0], np.cumsum(sizes)])
        self.terms = terms.flatten().to_numpy(zero_copy_only=False)
        self.impacts = impacts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.squares = np.bincount(np.repeat(np.arange(len(ids)), sizes), self.impacts.astype(np.float64) ** 2, len(ids))
        order = np.argsort(self.terms, kind="stable")
        self.rows, self.values = np.repeat(np.arange(len(ids)), sizes)[order], self.impacts[order]
        self.known, self.first = np.unique(self.terms[order], return_index=True)
        self.end = np.append(self.first[1:], len(order))
        self.most = np.maximum.reduceat(self.values, self.first) if len(order) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (their places here) that may reach ``least``, and their exact scores above 0."""
        place = np.searchsorted(self.known, terms)
        here = (place < len(self.known)) & (self.known[np.minimum(place, len(self.known) - 1)] == terms)
        place, terms, weights = place[here], terms[here], weights[here]
        listed = self.end[place] - self.first[place]
        order = np.argsort(listed, kind="stable")
        place, terms, weights = place[order], terms[order], weights[order]
        can_add = np.append(np.cumsum((weights * self.most[place])[::-1])[::-1], 0)  # by the terms from each on
        if not len(terms) or can_add[0] < max(least, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        focus = int(np.argmax(can_add < max(least, 1)))  # the first ``focus`` terms; without them it is out of reach
        rows = [self.rows[self.first[p] : self.end[p]] for p in place[:focus]]
        values = [self.values[self.first[p] : self.end[p]] for p in place[:focus]]
        at, value = np.concatenate(rows), np.concatenate(values).astype(np.float64)
        weight = np.repeat(weights[:focus].astype(np.float64), [len(r) for r in rows])
        partial = np.bincount(at, weight * value, len(self.ids))
        seen = np.bincount(at, value * value, len(self.ids))
        rest = weights[focus:].astype(np.float64)
        by_length = np.sqrt((rest * rest).sum() * np.maximum(self.squares - seen, 0))
        bound = partial + np.minimum(by_length, can_add[focus]) * (1 + 1e-9) + 1e-6 * (partial + 1)
        found = np.nonzero((seen > 0) & (bound >= least))[0]
        return found, self.exact(found, terms, weights)

    def exact(self, found: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of these documents in integers."""
        sizes = self.starts[found + 1] - self.starts[found]
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(found) else np.zeros(0, np.int64)
        entries = np.arange(sizes.sum()) + np.repeat(self.starts[found] - firsts, sizes)
        order = np.argsort(terms)
        place = np.minimum(np.searchsorted(terms[order], self.terms[entries]), len(terms) - 1)
        weight = np.where(terms[order][place] == self.terms[entries], weights[order][place], 0)
        return np.add.reduceat(weight * self.impacts[entries], firsts) if len(found) else np.zeros(0, np.int64)


def best_of(
    batches: Iterator[pa.RecordBatch], queries: Queries, least: np.ndarray, k: int
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each item's ``k`` best documents (ids, scores) of buckets (doc_id, length, terms, impacts)."""
    lengths = queries.lengths()
    ids = [np.zeros(0, np.int64) for _ in lengths]
    scores = [np.zeros(0, np.int64) for _ in lengths]
    least = least.copy()
    for batch in slices(batches, BUCKET):
        if not batch.num_rows:
            continue
        longest = float(batch.column(1).to_numpy().max())
        open_ = np.nonzero(lengths * longest * (1 + 1e-9) + 1 >= least)[0]
        if not len(open_):
            continue
        bucket = Bucket(batch.column(0).to_numpy(), batch.column(2), batch.column(3))
        for i in open_:
            found, score = bucket.search(queries.terms[i], queries.weights[i], int(least[i]))
            if not len(found):
                continue
            all_ids, all_scores = np.append(ids[i], bucket.ids[found]), np.append(scores[i], score)
            kept = np.lexsort((all_ids, -all_scores))[:k]
            kept = kept[all_scores[kept] > 0]
            ids[i], scores[i] = all_ids[kept], all_scores[kept]
            if len(kept) == k:
                least[i] = max(least[i], scores[i][-1])
    return ids, scores


def _impacts(counted: DataFrame, documents: int, terms: int) -> DataFrame:
    """(doc_id, length, terms, impacts), longest first."""
    # In decimals: the product outgrows 64 bits on large corpora.
    share = F.expr(f"(cast(n as decimal(18,0)) * cast('{LENGTH_PERCENT * documents}' as decimal(20,0))) div {max(terms, 1)}")
    damped = F.lit(SATURATION) * (F.lit(100 - LENGTH_PERCENT) + share.cast("long"))
    valued = counted.where(F.size("terms") > 0).withColumn("damped", damped)
    valued = valued.withColumn(
        "impacts", F.expr(f"transform(tf, f -> cast(({SCALE}L * f) div (1000L * f + damped) as int))")
    )
    square = F.aggregate("impacts", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return valued.select("doc_id", F.sqrt(square).alias("length"), "terms", "impacts")


def _octave(length):
    """Lengths in four steps for each doubling."""
    return F.floor(4 * F.log2(F.greatest(length, F.lit(1.0)))).cast("int")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    block_terms: int = BLOCK_TERMS,
    seeds: int = SEEDS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` documents of the highest scores above 0 of every item."""
    spark = docs.sparkSession
    wanted = written(item_terms(items, item, text), "item-terms")
    kind = dict(wanted.dtypes)["item"]
    blocks = max(1, -(-wanted.count() // block_terms))
    found = spark.createDataFrame([], f"{item} {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        here = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        part = _search_block(spark, docs, [(r["item"], bytes(r["term"]), r["n"]) for r in here.collect()], kind, k, key, text, seeds)
        found = found.unionByName(part.withColumnRenamed("item", item)) if part is not None else found
    return found


def _search_block(spark: SparkSession, docs, wanted: list[tuple], kind: str, k: int, key: str, text: str, seeds: int):
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, t, _ in wanted}))}
    if not vocabulary:
        return None
    counted = written(document_terms(docs, key, text, vocabulary), "document-terms")
    documents, terms = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row for each term
        holders[r["term"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in holders]
    by_item: dict = {}
    for name, term, n in wanted:
        number = vocabulary[term]
        if weight[number] and holders[number]:
            by_item.setdefault(name, []).append((number, weight[number] * n))
    if not by_item:
        return None
    names = list(by_item)
    queries = Queries(
        [np.array([t for t, _ in by_item[i]], np.int32) for i in names],
        [np.array([w for _, w in by_item[i]], np.int64) for i in names],
    )
    shared = spark.sparkContext.broadcast(queries)

    longest_first = [F.desc("length"), F.col("row")]
    numbered = _impacts(counted, documents, terms).withColumn("row", F.monotonically_increasing_id())
    # A given number of partitions is not merged, so the search has as many files to share out.
    ranges = numbered.repartitionByRange(shuffle_partitions(spark), *longest_first)
    ordered = ranges.sortWithinPartitions(*longest_first).drop("row")
    vectors = written(ordered, "impact-vectors")
    steps = sorted(((r["step"], r["count"]) for r in vectors.groupBy(_octave(F.col("length")).alias("step")).count().collect()), reverse=True)
    cut, sum_ = steps[0][0], 0
    for cut, n in steps:  # noqa: B007
        sum_ += n
        if sum_ >= seeds:
            break

    def search(part: DataFrame, least: np.ndarray) -> DataFrame:
        schema = pa.schema([("place", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, scores = best_of(batches, shared.value, least, k)
            places = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
            yield arrow_batch(schema, {"place": places, "doc_id": np.concatenate(ids), "score": np.concatenate(scores)})

        return part.mapInArrow(best, "place int, doc_id long, score long")

    order = Window.partitionBy("place").orderBy(F.desc("score"), "doc_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    first = written(search(vectors.where(_octave(F.col("length")) >= cut), np.zeros(len(names), np.int64)), "longest")
    least = np.zeros(len(names), np.int64)
    for r in top(first).where(F.col("rank") == k).collect():  # one row for each item
        least[r["place"]] = r["score"]
    short = float((least / queries.lengths()).min()) * (1 - 1e-9)  # vectors below this length reach no threshold
    rest = vectors.where((_octave(F.col("length")) < cut) & (F.col("length") >= short))
    best = top(first.unionByName(search(rest, least)))
    labels = spark.createDataFrame([(i, n) for i, n in enumerate(names)], f"place int, item {kind}")
    named = best.join(labels, "place")
    return named.select("item", "rank", F.nullif("doc_id", F.lit(_LAST)).alias("doc_id"), "score")
