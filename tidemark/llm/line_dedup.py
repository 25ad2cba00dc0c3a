"""Lines that many documents share, dropped by probing a sharded minimal perfect hash.

A line's key is hashed to 128 bits. Keys found in at least two documents are dealt to
shards of bounded size; each shard is a minimal perfect hash (cascaded bit arrays: a key
owns the slot of the first level where no other key falls on its bit) that indexes an
array of 64-bit fingerprints and an array of document counts. A key of a single document
can never reach the threshold, so it is not indexed; the fingerprint tells that it is
absent. Documents probe the arrays and are not joined with lines.

An index of at most ``SENT_BYTES`` travels to the tasks. A larger one stays where it is: line
hashes are sent to its shards, each dealt to as many salts as rows ask for, and only the
places of dropped lines come back. Both give the same rows.

A null or empty text is one empty line; an empty key is never dropped unless
``min_chars`` is 0. A document is a row, whatever its id: repeated rows, and rows of one id, count each. An empty table
gives no rows; texts and lines of any length are read whole.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batch, slices, text_bytes, written

SHARD_KEYS = 500_000
SENT_BYTES = 32_000_000
#: Line hashes that are probed together in one group of the routed path.
ROUTED_TOGETHER = 1_000_000
_STRIPPED = b" \t\n\x0b\x0c\r"
_GAMMA = 2.0


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z in lower case (``lower`` of bytes knows ASCII only)."""
    return line.strip(_STRIPPED).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def hashes(keys: list[bytes]) -> np.ndarray:
    """Two unsigned 64-bit numbers for each key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype="<u8").reshape(-1, 2)


def _bit(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """A place below ``size`` from all 128 bits: keys that share half of them part at the next level."""
    x = (h1 ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)) + h2 * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x ^ (x >> np.uint64(32))) % np.uint64(size)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit numbers: about three bits and a rank for each."""

    #: Half of the keys or more find a place at each level; equal keys never do.
    LEVELS = 200

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels, base = [], 0
        for size, bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.levels.append((size, bits, base + np.cumsum(ones) - ones))
            base += int(ones.sum())
        self.keys = base

    @staticmethod
    def build(h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        while len(h1):
            if len(levels) == PerfectHash.LEVELS:
                raise ValueError("a perfect hash needs distinct keys")
            size = max(64, -(-int(len(h1) * _GAMMA) // 64) * 64)
            place = _bit(h1, h2, len(levels), size)
            alone = np.bincount(place.astype(np.int64), minlength=size)[place.astype(np.int64)] == 1
            bits = np.zeros(size // 64, dtype=np.uint64)
            own = place[alone]
            np.bitwise_or.at(bits, (own >> np.uint64(6)).astype(np.int64), np.uint64(1) << (own & np.uint64(63)))
            levels.append((size, bits))
            h1, h2 = h1[~alone], h2[~alone]
        return PerfectHash(levels)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level holds it, any slot where it is foreign."""
        slot, left = np.full(len(h1), -1, dtype=np.int64), np.arange(len(h1))
        for level, (size, bits, rank) in enumerate(self.levels):
            place = _bit(h1[left], h2[left], level, size)
            word, inside = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (bits[word] >> inside) & np.uint64(1) == 1
            below = bits[word[here]] & ((np.uint64(1) << inside[here]) - np.uint64(1))
            slot[left[here]] = rank[word[here]] + np.bitwise_count(below)
            left = left[~here]
            if not len(left):
                break
        return slot


class Shard:
    """Fingerprints and counts of a shard's keys, in the slots of its perfect hash."""

    def __init__(self, perfect: PerfectHash, prints: np.ndarray, counts: np.ndarray):
        self.perfect, self.prints, self.counts = perfect, prints, counts

    @staticmethod
    def build(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> bytes:
        perfect = PerfectHash.build(keys, prints)
        slots = perfect.slots(keys, prints)
        by_print, by_count = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint32)
        by_print[slots], by_count[slots] = prints, np.minimum(counts, 0xFFFFFFFF)
        out = io.BytesIO()
        bits = {f"bits{i}": bits for i, (_, bits, _) in enumerate(perfect.levels)}
        np.savez(out, prints=by_print, counts=by_count, **bits)
        return out.getvalue()

    @staticmethod
    def load(blob: bytes) -> Shard:
        with np.load(io.BytesIO(blob)) as parts:
            levels = [parts[f"bits{i}"] for i in range(len(parts.files) - 2)]
            return Shard(PerfectHash([(64 * len(b), b) for b in levels]), parts["prints"], parts["counts"])

    def counts_of(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        slot = self.perfect.slots(keys, prints)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == prints[known]
        found = np.zeros(len(keys), dtype=np.int64)
        found[known] = self.counts[slot[known]]
        return found


def line_index(docs: DataFrame, min_chars: int = 1) -> tuple[DataFrame, int]:
    """(shard, blob) of all keys that at least two documents have, and the number of shards.

    A shard without keys has no row.
    """
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64())])

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: list[bytes] = []
            for text in batch.column(0).to_pylist():
                found.extend(k for k in set(map(line_key, text.split(b"\n"))) if _long_enough(k, min_chars))
            h = hashes(found).view(np.int64)
            yield arrow_batch(schema, {"h1": h[:, 0], "h2": h[:, 1]})

    shared = written(
        docs.select(text_bytes("text").alias("text"))
        .mapInArrow(keys_of, "h1 long, h2 long")
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where("n > 1"),
        "lines",
    )
    shards = max(1, -(-shared.count() // SHARD_KEYS))

    def build(group: pa.Table) -> pa.Table:
        h1, h2, n, shard = (group.column(c).to_numpy() for c in ("h1", "h2", "n", "shard"))
        blob = Shard.build(h1.view(np.uint64), h2.view(np.uint64), n)
        return pa.table({"shard": pa.array(shard[:1]), "blob": pa.array([blob], pa.binary())})

    index = (
        shared.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("long"))
        .groupBy("shard")
        .applyInArrow(build, "shard long, blob binary")
    )
    return written(index, "line-index"), shards


def _without(text: bytes | None, drop: np.ndarray, lines: list[bytes]):
    return text if not drop.any() else b"\n".join(x for x, d in zip(lines, drop, strict=True) if not d)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with shared lines left out of ``text``, and n_lines and n_dropped (these replace
    columns of their names). Other columns stay as they are."""
    spark = docs.sparkSession
    index, shards = line_index(docs, min_chars)
    size = index.agg(F.sum(F.length("blob"))).first()[0] or 0
    plain = docs.drop("n_lines", "n_dropped").withColumn("text", F.col("text").cast("string"))
    if size <= SENT_BYTES:
        sent = spark.sparkContext.broadcast({r["shard"]: bytes(r["blob"]) for r in index.collect()})
        return _probe_sent(plain, sent, shards, min_docs, min_chars)
    return _probe_routed(plain, index, shards, min_docs, min_chars)


def _probe_sent(plain: DataFrame, sent, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    shape = ", ".join(f"`{c}` {kind}" for c, kind in plain.dtypes) + ", n_lines long, n_dropped long"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in slices(batches):
            index = index or {s: Shard.load(b) for s, b in sent.value.items()}
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            lines = [(t or b"").split(b"\n") for t in texts]
            keys = [line_key(x) for doc in lines for x in doc]
            drop = np.zeros(len(keys), dtype=bool)
            h = hashes(keys)
            shard = np.ascontiguousarray(h[:, 0]).view(np.int64) % shards  # never negative, as pmod
            for s, one in index.items():
                here = np.flatnonzero(shard == s)
                drop[here] = one.counts_of(h[here, 0], h[here, 1]) >= min_docs
            drop &= np.fromiter((_long_enough(k, min_chars) for k in keys), dtype=bool, count=len(keys))
            ends = np.cumsum([len(x) for x in lines])
            parts = np.split(drop, ends[:-1])
            kept = [_without(t, d, x) for t, d, x in zip(texts, parts, lines, strict=True)]
            batch = batch.set_column(at, "text", pa.array(kept, pa.binary()).cast(pa.string()))
            batch = batch.append_column("n_lines", pa.array([len(x) for x in lines], pa.int64()))
            yield batch.append_column("n_dropped", pa.array([int(d.sum()) for d in parts], pa.int64()))

    return plain.mapInArrow(probe, shape)


def _probe_routed(plain: DataFrame, index: DataFrame, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    rows = written(plain.withColumn("_row", F.monotonically_increasing_id()), "line-docs")
    schema = pa.schema([("_row", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {"_row": [], "line": [], "keys": []}
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        out["_row"].append(row)
                        out["line"].append(i)
                        out["keys"].append(key)
            h = hashes(out.pop("keys")).view(np.int64)
            yield arrow_batch(schema, out | {"h1": h[:, 0], "h2": h[:, 1]})

    probes = rows.select("_row", text_bytes("text").alias("text")).mapInArrow(
        keys_of, "_row long, line int, h1 long, h2 long"
    )
    probes = written(probes, "line-probes")
    salts = max(1, -(-probes.count() // (ROUTED_TOGETHER * shards)))
    probes = probes.withColumns(
        {"shard": F.pmod("h1", F.lit(shards)).cast("long"), "salt": F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int")}
    )
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return left.select(["_row", "line"]).slice(0, 0)
        shard = Shard.load(right.column("blob")[0].as_py())
        h1, h2 = (left.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        return left.select(["_row", "line"]).filter(pa.array(shard.counts_of(h1, h2) >= min_docs))

    dropped = (
        probes.groupBy("shard", "salt")
        .cogroup(copies.groupBy("shard", "salt"))
        .applyInArrow(probe, "_row long, line int")
        .groupBy("_row")
        .agg(F.collect_set("line").alias("_lines"))
    )
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    gone = F.coalesce("_lines", F.array().cast("array<int>"))
    return (
        rows.join(dropped, "_row", "left")
        .withColumns({"n_lines": F.size(lines).cast("long"), "n_dropped": F.size(gone).cast("long")})
        .withColumn(
            "text",
            F.when(F.size(gone) == 0, F.col("text")).otherwise(
                F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
            ),
        )
        .drop("_row", "_lines")
    )
