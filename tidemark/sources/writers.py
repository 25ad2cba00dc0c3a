"""Partitioned tables, shards, size-bounded parts, and their manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import shard_of
from tidemark.operators.ordering import byte_buckets
from tidemark.sources.readers import below, file_digests


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], fmt: str = "parquet"
) -> None:
    """Write once, partitioned and sorted by key inside each file; never overwrite.

    Rows are range-partitioned on (partition columns, key): a partition value that holds a
    third of the table becomes several files, written by several tasks.
    """
    keys = [*partitions, *order]
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.partitionBy(*partitions)
        .mode("errorifexists")
        .format(fmt)
        .save(path)
    )


def write_shards(df: DataFrame, path: str, key: str, fmt: str = "json") -> None:
    """Sixteen shard folders by the hash of the key, sorted by key."""
    write_partitioned(df.withColumn("shard", shard_of(F.col(key))), path, ["shard"], [key], fmt)


def json_line_bytes(df: DataFrame) -> Column:
    """Length of a row as one JSON line."""
    return F.octet_length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})) + F.lit(1)


def size_bounded_parts(df: DataFrame, order: Sequence[str | Column], max_bytes: int) -> DataFrame:
    """Rows with the number of the size-bounded part they go to, and their line size."""
    return byte_buckets(df.withColumn("line_bytes", json_line_bytes(df).cast("long")), order, "line_bytes", max_bytes, "part")


def part_summary(parts: DataFrame) -> DataFrame:
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("line_bytes").alias("byte_size")
    )


def table_manifest(spark: SparkSession, root: str, table: str, glob: str = "part-*", folder: str = "") -> DataFrame:
    """One entry per physical file of a table written to ``folder`` below ``root``: path below ``root``, digest, size."""
    digests = file_digests(spark, f"{root}/{folder}" if folder else root, glob)
    return digests.select(F.lit(table).alias("table_name"), below("path", root).alias("file"), "sha256", "byte_size")


def coverage_of(df: DataFrame, dates: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """The coverage part of a manifest: records, distinct keys, and first and last of each date column."""
    spans = [f(c).cast("string").alias(f"{c}_{n}") for c in dates for n, f in (("first", F.min), ("last", F.max))]
    count = [F.countDistinct(*[F.col(k) for k in keys]).alias("key_count")] if keys else []
    return df.agg(F.count(F.lit(1)).alias("record_count"), *count, *spans)


def table_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Record count and key of each logical table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count", F.lit(",".join(keys)).alias("primary_key")
        )
        for name, (df, keys) in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def provenance(manifests: DataFrame, digests: DataFrame) -> DataFrame:
    """One row per source bundle: its file digest, size, dates and counts."""
    return manifests.join(digests, "path", "left").select(
        "domain", "path", "sha256", "byte_size", "bundle_id", "as_of_date", "fetched_at", "record_count"
    )
