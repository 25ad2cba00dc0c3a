"""Streaming queries, run to their end and compared with a batch over the whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.registry import register, table
from tidemark.session import shared_folder
from tidemark.streaming import jobs


@register(
    "stream_ingest_dedup",
    """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_ingest_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The newest event of every user, kept by a stream over the events file."""
    schema = table(spark, folder, "events").schema
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    keys, order = ["user_id"], ["ts", "event_id"]

    def start():
        stream = jobs.file_stream(spark, folder, schema, "parquet", "events.parquet")
        return jobs.upsert_latest(stream, f"{place}/rows", f"{place}/checkpoint", keys, order)

    jobs.run_to_end(start)
    newest = jobs.latest_versions(spark, f"{place}/rows", schema, keys, order)
    return newest.select("user_id", "event_id", "event_type")


#: A year: longer than the events span, so that a key seen once is not new again.
_YEAR_MS = 366 * 86_400_000


@register(
    "stream_first_seen",
    """SELECT user_id, event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """The first event of every user and kind, kept by a stateful stream over several batches.

    The events come in four deliveries by time, and the stream runs on after each of them.
    """
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    cuts = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select(
        *[(F.unix_micros("low") + (F.unix_micros("high") - F.unix_micros("low")) * i / 4).cast("long") for i in (1, 2, 3)]
    ).first()

    def start():
        stream = jobs.file_stream(spark, f"{place}/in", events.schema, "parquet")
        first = jobs.first_seen(stream, ["user_id", "event_type"], "ts", _YEAR_MS, ["event_id"])
        return jobs.append_all(first, f"{place}/out", f"{place}/checkpoint")

    delivery = sum((F.coalesce(F.unix_micros("ts") > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    for number in range(4):
        events.where(delivery == number).write.mode("append").parquet(f"{place}/in")
        jobs.run_to_end(start)
    found = spark.read.schema(events.schema).parquet(f"{place}/out")
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
