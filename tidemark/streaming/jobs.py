"""Incremental ingest, id deduplication and a latest-version table kept by upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.versions import latest_by

BATCH = "batch"


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path``; the checkpoint of the query remembers those already read."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def ingest_once(stream: DataFrame, target: str, checkpoint: str, partitions: Sequence[str] = ()) -> StreamingQuery:
    """Append everything new to ``target``, each input exactly once, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.outputMode("append").trigger(availableNow=True).start()


def first_arrivals(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first arrival of each id; repeats within ``delay`` are dropped.

    A later fetch with other content is a repeat here; :func:`upsert_latest` keeps it.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups of keys. A call of the processor with its accesses to the state costs as much as many rows, so it serves all keys of a group.
GROUPS = 4096


class FirstSeen(StatefulProcessor):
    """Lets the first row of a key through and remembers the key until a timer finds its time passed.

    The time stands ``delay_ms`` after the event time of the row let through, so the state holds the keys of
    that span only. A repeat before then is dropped, whether it comes in the same batch or in a later one; after then
    the key is new again. Of several rows of one batch the one with the smallest event time, then the
    smallest ``order`` columns, counts as the first.

    A call serves one group of keys, whose state is one value: the keys as text and the time of each. It is read when the group
    has rows or its earliest time has passed, and written when its keys change.
    """

    def __init__(self, schema: StructType, keys: list[str], event_time: str, order: list[str], delay_ms: int):
        self.names, self.delay_ms = schema.names, delay_ms
        self.keys = [self.names.index(c) for c in keys]
        self.time = self.names.index(event_time)
        self.order = [self.time, *(self.names.index(c) for c in order)]

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "members array<string>, until array<long>")

    def member(self, row) -> str:
        values = (row[i] for i in self.keys)
        return repr([v.astimezone(timezone.utc) if isinstance(v, datetime) and v.tzinfo else v for v in values])

    def rank(self, row) -> list:
        return [(row[i] is not None, row[i]) for i in self.order]

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 (names of the interface)
        firsts = {}
        for row in rows:
            member = self.member(row)
            if member not in firsts or self.rank(row) < self.rank(firsts[member]):
                firsts[member] = row
        members, until = self.seen.get() or ([], [])
        for member in members:
            firsts.pop(member, None)
        if firsts:
            fresh = [int(row[self.time].timestamp() * 1000) + self.delay_ms for row in firsts.values()]
            if not until or min(fresh) < min(until):
                self.handle.registerTimer(min(fresh))
            self.seen.update(([*members, *firsts], [*until, *fresh]))
        shape = Row(*self.names)
        return iter([shape(*row[: len(self.names)]) for row in firsts.values()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        members, until = self.seen.get() or ([], [])
        kept = [(m, u) for m, u in zip(members, until, strict=True) if u > now]
        if not kept:
            self.seen.clear()
        elif len(kept) < len(members):
            self.seen.update(tuple(map(list, zip(*kept, strict=True))))
            self.handle.registerTimer(min(u for _, u in kept))
        return iter([])

    def close(self) -> None:
        pass


def first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay_ms: int, order: Sequence[str] = (), groups: int = GROUPS
) -> DataFrame:
    """The first arrival of each key, by state that a timer frees; see :class:`FirstSeen`.

    Rows without an event time are left out, and rows older than the watermark (``delay_ms`` behind the newest row) are too late.
    The session needs the state store ``ROCKSDB``. A hash deals the keys into ``groups``, a number that stays as it is for the life
    of a checkpoint; with some hundred to some thousand keys in a group, calls are few and a group's state is small.
    """
    stream = stream.where(F.col(event_time).isNotNull()).withWatermark(event_time, f"{delay_ms} milliseconds")
    group = "group" + "_" * max(map(len, stream.columns))
    grouped = stream.withColumn(group, F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")).groupBy(group)
    return grouped.transformWithState(
        FirstSeen(stream.schema, list(keys), event_time, list(order), delay_ms), stream.schema, "Append", "EventTime"
    )


def append_all(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stateful stream to ``target`` in as many batches as its source gives, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
    return writer.outputMode("append").trigger(availableNow=True).start()


def upsert_latest(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str | Column]
) -> StreamingQuery:
    """Keep versions per key in ``target``; :func:`latest_versions` reads the newest of each.

    A batch writes the newest version of its own keys to a folder of its own and reads nothing
    of the target, so its work grows with the batch alone. A batch that is replayed after a
    failure overwrites its own folder. No watermark: a late fetch is a version, not an event
    to drop.
    """

    def keep(batch: DataFrame, number: int) -> None:
        latest_by(batch, keys, order).write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_versions(
    spark: SparkSession, target: str, schema: StructType, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The newest version of every key over all batches; of equal ones, the later batch's."""
    if not existing(spark, target):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema, StructField(BATCH, LongType())])).parquet(target)
    return latest_by(rows, keys, [*order, BATCH]).select(*schema.names)


def compact(
    spark: SparkSession, target: str, fresh: str, schema: StructType, keys: Sequence[str], order: Sequence[str | Column]
) -> None:
    """Write the newest versions of ``target`` as the first batch of the empty folder ``fresh``.

    Readers and the stream are pointed to ``fresh`` afterwards; ``target`` is left as it is.
    """
    latest_versions(spark, target, schema, keys, order).write.mode("overwrite").parquet(f"{fresh}/{BATCH}=-1")


def existing(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def run_to_end(start: Callable[[], StreamingQuery]) -> None:
    query = start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
