"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set is its distinct word shingles as 64-bit hashes. Documents of one set are
a class, and only its smallest document goes on. A signature has ``chunks * LENGTH``
positions of 16 bits. If two signatures differ in fewer than ``2 * chunks`` positions,
some chunk differs in at most one (pigeonhole), so enumerating the one error a chunk may
have, a key for each position left out, brings every such pair into a bucket. ``chunks``
is the smallest number at which a pair of just the asked similarity differs in more
positions with a probability under ``MISSED``: 11 for 0.85 and 19 for 0.8.

Buckets are closed under "signatures fewer than ``2 * chunks`` apart" and give spanning links,
not pairs; the components of these links hold every candidate pair. In each component the
full sets decide: members are compared with one hub at a time, the member nearest to the
component's common signature first, and whoever is not yet in the hub's class is compared
with all others, so no link between classes is missed while members of one class are not
compared again. Buckets and components over a bound are split into blocks, and every pair
of blocks is one bounded group.

A document with fewer words than a shingle has its whole sequence as one; one without
words, or a null text, has an empty set and is linked with nothing. ``doc_id`` is the
key of a document; rows that share one get a component each for their own set, and these may be joined. A document with a null id whose set no other one has
is in no component (component_id and kept are null); a copy of another document is in that one's. Texts of any length are compared
whole; other columns are left out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batch, slices, text_bytes, written
from tidemark.llm.components import connected

#: Positions in a chunk.
LENGTH = 5
MISSED = 1e-5
#: Members of a bucket, and shingles of a component, that are held in one group.
BUCKET_MEMBERS = 40_000
COMPONENT_SHINGLES = 4_000_000
#: Shingles that a full set is compared with at a time.
COMPARED = 200_000

_MIX_1, _MIX_2, _MIX_3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_ODD = np.random.default_rng(20).integers(1, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def chunks_for(similarity: float) -> int:
    """Chunks at which a pair of this similarity is missed with a probability under ``MISSED``."""
    p = 1 - similarity
    for chunks in range(2, len(_ODD) // LENGTH):
        n = chunks * LENGTH
        if sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(2 * chunks, n + 1)) < MISSED:
            return chunks
    raise ValueError(f"similarity too low for this index: {similarity}")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of the base of the rolling hash and their inverses, as long as texts need."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BASE, -m, 1 << 64))])


_POWERS = Powers()


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = b" ".join(texts)
    raw = np.frombuffer(joined.lower() + b" ", dtype=np.uint8)
    _POWERS.reach(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(raw)])])
    inside = np.concatenate([[False], ~_SPACE[raw]])
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    word = _mixed((sums[end] - sums[begin]) * _POWERS.down[begin] + (end - begin).astype(np.uint64) * _MIX_3)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begin, text_ends, "left")
    sets, first = [], 0
    for last in upto:
        n = last - first
        size = min(width, n)
        if not n:
            sets.append(np.empty(0, dtype=np.uint64))
        else:
            mixed = np.full(n - size + 1, np.uint64(size))
            for k in range(size):
                mixed = (mixed ^ word[first + k : first + k + len(mixed)]) * _MIX_1 + _MIX_2
            sets.append(np.unique(_mixed(mixed)))
        first = last
    return sets


def signature(shingles: np.ndarray, positions: int) -> bytes:
    """16 bits of the smallest value of each of ``positions`` hashes of the set."""
    least = np.full(positions, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        least = np.minimum(least, (_mixed(part ^ _MIX_2)[None, :] * _ODD[:positions, None]).min(axis=1))
    return (_mixed(least) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _signatures(docs: DataFrame, width: int, positions: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary())]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            digest = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
            h = np.frombuffer(digest, dtype="<i8").reshape(-1, 2)
            found = {"n": [len(s) for s in sets], "h1": h[:, 0], "h2": h[:, 1]}
            found["sig"] = [signature(s, positions) if len(s) else b"" for s in sets]
            yield arrow_batch(schema, {"doc_id": batch.column(0)} | found)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")).mapInArrow(
        sign, "doc_id long, n long, h1 long, h2 long, sig binary"
    )


def _keys(reps: DataFrame, chunks: int) -> DataFrame:
    """(key, rep): a key for each chunk and each of its positions left out."""
    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64())])

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(-1, chunks, LENGTH)
            rep = batch.column(0).to_numpy()
            keys = []
            for chunk in range(chunks):
                for out in range(LENGTH):
                    key = np.full(len(sigs), np.uint64(chunk * LENGTH + out + 1))
                    for k in range(LENGTH):
                        if k != out:
                            key = (key ^ sigs[:, chunk, k].astype(np.uint64)) * _MIX_1 + _MIX_2
                            key ^= key >> np.uint64(32)
                    keys.append(_mixed(key))
            yield arrow_batch(schema, {"key": np.concatenate(keys).view(np.int64), "rep": np.tile(rep, chunks * LENGTH)})

    return reps.select("rep", "sig").mapInArrow(keys_of, "key long, rep long")


def closure(n: int, linked: Callable[[int, np.ndarray], np.ndarray], order: np.ndarray) -> np.ndarray:
    """Labels of the classes of ``n`` members under ``linked(member, others)``.

    Members are tried in ``order`` against all that are not in their class yet; one that a
    former test has reached is passed over at first. In the end all but the largest class
    are tried as well, so of any two members in different classes one was compared with
    the other.
    """
    label, reached, tried = np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)

    def attempt(m: int) -> None:
        tried[m] = True
        others = np.flatnonzero(label != label[m])
        if not len(others):
            return
        hits = others[linked(m, others)]
        if len(hits):
            label[np.isin(label, label[hits])] = label[m]
            reached[hits] = True

    for m in order:
        if not reached[m]:
            attempt(int(m))
    inside = int(np.argmax(np.bincount(label, minlength=n)[label])) if n else 0  # a member of the largest class
    for m in order:
        if not tried[m] and label[m] != label[inside]:
            attempt(int(m))
    return label


def stars(label: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every member to the smallest of its class; the same smallest in many groups gives
    the same links, which leaves little to connect."""
    least = np.full(len(label), np.iinfo(np.int64).max)
    np.minimum.at(least, label, rep)
    root = least[label]
    return root[root != rep], rep[root != rep]


def _bucket_links(rows: DataFrame, similarity: tuple[int, int], chunks: int) -> DataFrame:
    """(a, b): spanning links of each group of rows (key, i, j, rep, n, sig), sorted by group."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    top, of = similarity

    def near(sig: np.ndarray, n: np.ndarray, m: int, others: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n[m], n[others]), np.maximum(n[m], n[others])
        ok = of * small >= top * large
        ok[ok] = (sig[others[ok]] != sig[m]).sum(axis=1) < 2 * chunks
        return ok

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(final: bool):
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = [whole.column(c).to_numpy() for c in ("key", "i", "j")]
            rep, n = whole.column("rep").to_numpy(), whole.column("n").to_numpy()
            sig = np.frombuffer(b"".join(whole.column("sig").to_pylist()), dtype="<u2").reshape(-1, chunks * LENGTH)
            new = np.zeros(len(rep), dtype=bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(rep))
            if not final:
                starts, ends = starts[:-1], ends[:-1]
            a, b = [], []
            two = starts[ends - starts == 2]
            small, large = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
            ok = (of * small >= top * large) & ((sig[two] != sig[two + 1]).sum(axis=1) < 2 * chunks)
            a.extend(rep[two[ok]])
            b.extend(rep[two[ok] + 1])
            for s, e in zip(starts, ends, strict=True):
                if e - s > 2:
                    part_sig, part_n = sig[s:e], n[s:e]
                    label = closure(e - s, lambda m, o, x=part_sig, y=part_n: near(x, y, m, o), np.arange(e - s))
                    roots, members = stars(label, rep[s:e])
                    a.extend(roots)
                    b.extend(members)
            rest = whole.slice(int(ends[-1]) if len(ends) else 0)
            held[:] = rest.to_batches() if not final else []
            pairs = np.unique(np.sort(np.array([a, b], dtype=np.int64).T, axis=1), axis=0) if a else np.empty((0, 2), np.int64)
            return arrow_batch(schema, {"a": pairs[:, 0], "b": pairs[:, 1]})

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= 50_000:
                yield groups(False)
        if held:
            yield groups(True)

    return rows.mapInArrow(link, "a long, b long")


def in_blocks(rows: DataFrame, key: str, weight: str, member: str, bound: int) -> DataFrame:
    """``rows`` with block numbers i <= j: a group over ``bound`` is dealt to blocks, and every pair
    of blocks is a group (i, j); a smaller group is (0, 0)."""
    sizes = rows.groupBy(key).agg(F.ceil(F.sum(weight) / F.lit(bound)).cast("int").alias("_blocks")).where("_blocks > 1")
    block = F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int")
    dealt = rows.join(sizes, key, "left").withColumns(
        {"_blocks": F.coalesce("_blocks", F.lit(1)), "_own": F.coalesce(block, F.lit(0))}
    )
    return (
        dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})
        .drop("_blocks", "_own", "_other")
    )


def _verified(members: DataFrame, width: int, similarity: tuple[int, int], chunks: int) -> DataFrame:
    """(a, b): links between members (group, i, j, rep, sig, text) whose full sets are similar."""
    top, of = similarity

    def verify(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        sets = shingle_sets(group.column("text").to_pylist(), width)
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype="<u2").reshape(-1, chunks * LENGTH)
        n = np.array([len(s) for s in sets])
        flat, ends = np.concatenate(sets), np.cumsum(n)
        common = np.array([np.bincount(c).argmax() for c in sig.T])

        def batches_of(live: np.ndarray) -> list[np.ndarray]:
            """Members whose sets are compared at a time: ``COMPARED`` shingles, or a single set."""
            return np.split(live, np.flatnonzero(np.diff(np.cumsum(n[live]) // COMPARED)) + 1)

        def enough(m: int, live: np.ndarray) -> np.ndarray:
            first = np.cumsum(n[live]) - n[live]
            at = np.arange(n[live].sum()) + np.repeat(ends[live] - n[live] - first, n[live])
            place = np.searchsorted(sets[m], flat[at])
            place[place == n[m]] = 0
            shared = np.add.reduceat((sets[m][place] == flat[at]).astype(np.int32), first)
            return of * shared >= top * (n[m] + n[live] - shared)

        def similar(m: int, others: np.ndarray) -> np.ndarray:
            small, large = np.minimum(n[m], n[others]), np.maximum(n[m], n[others])
            ok = (of * small >= top * large) & (small > 0)  # no signature decides here, only full sets
            live = others[ok]
            if len(live):
                ok[ok] = np.concatenate([enough(m, part) for part in batches_of(live)])
            return ok

        order = np.argsort((sig != common).sum(axis=1), kind="stable")
        roots, found = stars(closure(len(rep), similar, order), rep)
        return pa.table({"a": roots, "b": found})

    return members.groupBy("group", "i", "j").applyInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Two documents are linked when ``similarity[1] * shared >= similarity[0] * united`` shingles.
    """
    chunks = chunks_for(similarity[0] / similarity[1])
    signed = written(_signatures(docs, width, chunks * LENGTH), "signatures")
    classes = written(
        signed.where("n > 0")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "classes",
    )
    keys = _keys(classes, chunks)
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    buckets = written(keys.join(shared, "key"), "buckets")
    rows = in_blocks(
        buckets.withColumn("one", F.lit(1)).join(classes.select("rep", "n", "sig"), "rep"),
        "key",
        "one",
        "rep",
        BUCKET_MEMBERS,
    )
    rows = rows.select("key", "i", "j", "rep", "n", "sig").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    groups = connected(_bucket_links(rows, similarity, chunks))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_bytes("text").alias("text"))
    members = (
        groups.select(F.col("node").alias("rep"), F.col("root").alias("group"))
        .join(classes.select("rep", "n", "sig"), "rep")
        .join(texts, "rep")
    )
    members = in_blocks(members, "group", "n", "rep", COMPONENT_SHINGLES)
    roots = connected(_verified(members.select("group", "i", "j", "rep", "sig", "text"), width, similarity, chunks))
    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("root", "rep").alias("component_id")
    )
    return (
        signed.drop("sig")
        .join(named, ["h1", "h2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
