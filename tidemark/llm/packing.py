"""Packing of tokenised documents into sequences of equal length.

Every document becomes its token ids and an end id and is cut into pieces of at most
``capacity`` ids. The lengths of pieces, rounded up to a few hundred *sizes*, form a
histogram; a cutting-stock linear program over it (:mod:`tidemark.llm.cutting_stock`)
gives patterns, and the pieces of every size, ranked by document, take the slots of the
patterns in turn. Only the histogram and the patterns, both bounded by the number of
sizes, meet on the driver; pieces are ranked in salted groups of a size, so copies of one
length do not meet in one task.

Null and empty texts are the end id alone. Repeated rows are packed like any others, as
rows of one ``doc_id``. An empty table gives no rows. A text of any length is cut into as many pieces as it needs. Other
columns than doc_id and text are left out, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import arrow_batch, shuffle_partitions, slices, text_bytes, written
from tidemark.llm.cutting_stock import solve

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PIECES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
#: Pieces of one size that are ranked together in one sorted group.
RANKED_TOGETHER = 200_000


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """One row for each piece of at most ``capacity`` ids; ``with_ids`` adds the ids themselves."""
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.word_ids import chunk_ids

        known, end = chunk_ids(vocabulary), int(end_id).to_bytes(4, "little")
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = known.of(text.decode()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(total)
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            yield arrow_batch(schema, out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")).mapInArrow(
        cut, PIECES + (", ids array<int>" if with_ids else "")
    )


def size_of(length, capacity: int):
    """A length rounded up to four ids, or to a sixteenth to a thirty-second of itself."""
    step = F.greatest(F.lit(4.0), F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double"))) - 5))
    return F.least(F.ceil(length / step) * step, F.lit(capacity)).cast("long")


def place(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a settled table of pieces."""
    spark = cut.sparkSession
    sized = cut.withColumn("_size", size_of(F.col("length"), capacity))
    histogram = {r["_size"]: r["n"] for r in sized.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return cut.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    sizes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    unit = 4 if capacity % 4 == 0 else 1
    patterns = solve(-(-sizes // unit), demand, capacity // unit)

    runs: dict[int, list[tuple[int, int, int]]] = {int(s): [] for s in sizes}  # first rank, copies, first sequence
    ranks, sequences = np.zeros(len(sizes), dtype=np.int64), 0
    for pattern, times in patterns:
        for i in np.flatnonzero(pattern):
            runs[int(sizes[i])].append((int(ranks[i]), int(pattern[i]), sequences))
            ranks[i] += int(pattern[i]) * times
        sequences += times
    lookup = spark.sparkContext.broadcast({s: np.array(r, dtype=np.int64).T for s, r in runs.items()})

    salts = max(shuffle_partitions(spark), -(-int(demand.max()) // RANKED_TOGETHER))
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    before = Window.partitionBy("_size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        salted.groupBy("_size", "_salt")
        .agg(F.count("*").alias("_n"))
        .select("_size", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_size", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.join(counts, ["_size", "_salt"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(within) - 1
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup.value
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_size", "_rank"))
            sequence, slot = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for s in np.unique(size):
                here = size == s
                first, copies, base = table[int(s)]
                at = np.searchsorted(first, rank[here], side="right") - 1
                along = rank[here] - first[at]
                sequence[here], slot[here] = base[at] + along // copies[at], along % copies[at]
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("_slot", pa.array(slot))

    shape = T.StructType([*ranked.schema, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "_slot"))])
    placed = ranked.mapInArrow(assign, shape)
    earlier = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("_size").desc(), "_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        *cut.columns, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    )


def pack(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    capacity: int = 4096,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with the sequence and the offset each one has.

    The pieces are written to the shared folder before they are counted, so a text is
    tokenised once. ``with_ids`` keeps the ids as a column, for writing training files.
    """
    cut = written(pieces(docs, vocabulary, end_id, capacity, with_ids), "pieces")
    spread = cut.repartition(shuffle_partitions(docs.sparkSession), "doc_id", "start") if with_ids else cut
    return place(spread, capacity)
