"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

Words are the symbols: a benchmark word has a number, any other word is 0, which no
pattern holds. A pattern is a window of ten consecutive words of an item, or a shorter item
as a whole; patterns of one length are searched together. Blocks of two words index a table
of shifts, which says how far the search may jump without passing an occurrence; where it
says 0, the bucket of that block names the patterns that can end there, and a comparison
of all words confirms. Many places of a batch of texts are searched in step with numpy.

The texts of at most about ``BLOCK_BYTES`` of the benchmark, which hold no more patterns than half as many, travel to
the tasks at once, and a worker builds their index once, for all its tasks. A larger benchmark is searched block by
block, each pass extending the spans found before.
Documents are never shuffled. A null text has no words; items that share an id are one item, and those with a null
id are one item too, which is named null, after all others. Repeated rows
each count for themselves; extra columns are left out. An empty table gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidemark.llm.common import slices, text_bytes, written

#: Benchmark text that is searched for in one pass.
BLOCK_BYTES = 8_000_000
#: Words between the starting points of two cursors.
STRIDE = 96
#: A-Z become a-z; every ASCII byte that is no letter or digit becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Patterns:
    """Patterns of one length: their shift table, and buckets by the hash of the last block."""

    BITS = 20

    def __init__(self, windows: np.ndarray, items: np.ndarray):
        """``windows`` of word numbers, with repeats, and the item of each."""
        whole = np.ascontiguousarray(windows).view(np.dtype((np.void, windows.dtype.itemsize * windows.shape[1]))).ravel()
        _, first, pattern = np.unique(whole, return_index=True, return_inverse=True)
        self.rows, self.length = windows[first], windows.shape[1]
        self.block = min(2, self.length)
        pairs = np.unique(np.stack([pattern.ravel(), items], axis=1), axis=0)
        self.owners = pairs[:, 1]
        self.owner_ends = np.cumsum(np.bincount(pairs[:, 0], minlength=len(self.rows)))
        rows = self.rows
        farthest = self.length - self.block + 1
        self.shift = np.full(1 << self.BITS, farthest, dtype=np.int16)
        for end in range(self.block, self.length + 1):
            np.minimum.at(self.shift, self._hash(rows[:, end - 1], rows[:, end - self.block]), self.length - end)
        last = self._hash(rows[:, -1], rows[:, -self.block])
        self.by_bucket = np.argsort(last, kind="stable")
        self.bucket = last[self.by_bucket]

    def _hash(self, word: np.ndarray, before: np.ndarray) -> np.ndarray:
        return (word.astype(np.int64) * 40503 + before.astype(np.int64) * 1_000_003) & ((1 << self.BITS) - 1)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of last words, and the pattern that ends at each."""
        starts = np.arange(self.length - 1, len(codes), STRIDE)
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, end = starts, np.minimum(starts + STRIDE, len(codes))
        ends = []
        while len(at):
            shift = self.shift[self._hash(codes[at], codes[at - self.block + 1])]
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            left = at < end
            at, end = at[left], end[left]
        at = np.concatenate(ends)
        key = self._hash(codes[at], codes[at - self.block + 1])
        low, high = np.searchsorted(self.bucket, key, "left"), np.searchsorted(self.bucket, key, "right")
        found_at, found = [], []
        for first in range(0, len(at), 4096):
            each = (high - low)[first : first + 4096]
            place = np.repeat(at[first : first + 4096], each)
            within = np.arange(len(place)) - np.repeat(np.cumsum(each) - each, each)
            pattern = self.by_bucket[np.repeat(low[first : first + 4096], each) + within]
            same = np.ones(len(place), dtype=bool)
            for k in range(self.length):
                live = np.flatnonzero(same)
                same[live] = codes[place[live] - k] == self.rows[pattern[live], self.length - 1 - k]
            found_at.append(place[same])
            found.append(pattern[same])
        return (np.concatenate(found_at), np.concatenate(found)) if found else (at, at)

    def owners_of(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The items of each pattern: index into ``patterns``, item number."""
        ends = self.owner_ends[patterns]
        begins = np.where(patterns > 0, self.owner_ends[patterns - 1], 0)
        each = ends - begins
        index = np.repeat(np.arange(len(patterns)), each)
        within = np.arange(len(index)) - np.repeat(np.cumsum(each) - each, each)
        return index, self.owners[np.repeat(begins, each) + within]


class Benchmark:
    """All patterns of some items, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.items = [i for i, _ in items]
        self.codes: dict[bytes, int] = {}
        by_size: dict[int, tuple[list, list]] = {}
        for number, (_, text) in enumerate(items):
            found = words(text)
            symbols = np.fromiter((self.codes.setdefault(w, len(self.codes) + 1) for w in found), np.int32, len(found))
            if len(symbols):
                windows, owners = by_size.setdefault(min(window, len(symbols)), ([], []))
                windows.append(np.lib.stride_tricks.sliding_window_view(symbols, min(window, len(symbols))))
                owners.append(np.full(len(windows[-1]), number))
        self.patterns = [Patterns(np.concatenate(w), np.concatenate(o)) for w, o in by_size.values()]


#: The index that this worker has built last, and the block it is of.
_BUILT: dict[str, Benchmark] = {}


def _index(block: str, items: list[tuple[str | None, bytes]], window: int) -> Benchmark:
    if block not in _BUILT:
        _BUILT.clear()
        _BUILT[block] = Benchmark(items, window)
    return _BUILT[block]


def _search(known: Benchmark, texts: list[bytes], items: list, spans: list):
    """Words of each text, and its items and merged spans with those found here added."""
    numbers, pieces = [], []
    for text in texts:
        found = words(text)
        numbers.append(len(found))
        pieces.append(np.fromiter(map(known.codes.get, found, repeat(0)), dtype=np.int32, count=len(found)))
        pieces.append(np.zeros(1, dtype=np.int32))
    codes = np.concatenate(pieces)
    first = np.concatenate([[0], np.cumsum(np.array(numbers) + 1)])
    marks = np.zeros(len(codes) + 1, dtype=np.int32)
    pairs = []
    for patterns in known.patterns:
        at, pattern = patterns.find(codes)
        if len(at):
            np.add.at(marks, at - patterns.length + 1, 1)
            np.add.at(marks, at + 1, -1)
            index, item = patterns.owners_of(pattern)
            pairs.append(np.stack([np.searchsorted(first, at[index], "right") - 1, item], axis=1))
    for i in np.flatnonzero([bool(s) for s in spans]):
        for s in spans[i]:
            marks[first[i] + s["start"]] += 1
            marks[first[i] + s["end"]] -= 1
    covered = np.cumsum(marks) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(np.int8)))
    merged: list[list] = [[] for _ in texts]
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        i = int(np.searchsorted(first, a, "right") - 1)
        merged[i].append({"start": int(a - first[i]), "end": int(b - first[i])})
    named = [set(i or ()) for i in items]
    if pairs:
        for i, item in np.unique(np.concatenate(pairs), axis=0):
            named[i].add(known.items[item])
    return numbers, [sorted(n, key=lambda x: (x is None, x or "")) for n in named], merged


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, items (item ids as sorted strings), spans (of hit words) and n_hit.

    ``doc_id`` may have any type; it is carried along.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_bytes("text").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    state = docs.select(F.col("doc_id"), text_bytes("text").alias("text")).withColumns(
        {
            "items": F.array().cast("array<string>"),
            "spans": F.array().cast("array<struct<start:int,end:int>>"),
        }
    )
    found_fields = state.schema.fields[2:]
    kind = StructField("doc_id", docs.schema["doc_id"].dataType)
    for block in range(blocks):
        here = items.where(F.coalesce(F.pmod(F.xxhash64("item_id"), F.lit(blocks)), F.lit(0)) == block)
        known = spark.sparkContext.broadcast([(r["item_id"], bytes(r["text"])) for r in here.collect()])
        last, name = block == blocks - 1, uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], known=known, last=last, name=name) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                index = _index(name, known.value, window)
                texts = batch.column(1).to_pylist()
                numbers, items, spans = _search(index, texts, batch.column(2).to_pylist(), batch.column(3).to_pylist())
                found = {"items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, span)}
                if last:
                    found = {"n_words": pa.array(numbers, pa.int64())} | found
                else:
                    found = {"text": batch.column(1)} | found
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0)} | found)

        more = StructField("n_words", LongType()) if last else StructField("text", BinaryType())
        state = state.mapInArrow(search, StructType([kind, more, *found_fields]))
        if not last:
            state = written(state, "passages")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return state.withColumn("n_hit", hit)
