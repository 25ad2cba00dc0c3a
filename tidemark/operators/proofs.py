"""Digests of row multisets, and what they prove: that parts are their source.

The digest of a table is the sum of its rows' digests. It does not depend on the order or the
partitioning of the rows, it counts repeats, and sums of parts add up to the sum of the whole, so
one partial aggregation compares tables of any size where ``exceptAll`` shuffles every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DECIMAL = "decimal(38,0)"


def row_text(columns: Sequence[str | Column]) -> Column:
    """The values of a row, each with its length, so that no two rows have one text; null is ``-``."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat(
        *[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def multiset_digest(row: Column) -> Column:
    """Aggregate: (rows, low, high) sums over two times 48 bits of the SHA-256 of each row text."""
    digest = F.sha2(row, 256)
    part = lambda at: F.conv(F.substring(digest, at, 12), 16, 10).cast(_DECIMAL)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(_DECIMAL)
    return F.struct(F.count(F.lit(1)).alias("rows"), total(part(1)).alias("low"), total(part(13)).alias("high"))


def table_digests(df: DataFrame, columns: Sequence[str | Column], group: Sequence[str] = ()) -> DataFrame:
    """One row for each group (or the table): rows, low, high."""
    return df.groupBy(*group).agg(multiset_digest(row_text(columns)).alias("__d")).select(*group, "__d.*")


def reassembly(parts: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row that says whether ``parts`` hold the rows of ``source``, each as often, and nothing else."""
    told = [
        df.agg(multiset_digest(row_text(columns)).alias(name)) for df, name in ((source, "source"), (parts, "parts"))
    ]
    return told[0].crossJoin(told[1]).select(  # one row each
        F.col("source.rows").alias("source_count"),
        F.col("parts.rows").alias("part_count"),
        (F.col("source") == F.col("parts")).alias("reassembles"),
    )


def part_faults(
    parts: DataFrame, max_bytes: int, part: str = "part", size: str = "line_bytes", declared: DataFrame | None = None
) -> DataFrame:
    """(part, fault): parts over the byte limit, and those that differ from their manifest.

    ``declared``: part, record_count, byte_size. A part on one side only is a fault as well.
    """
    actual = parts.groupBy(part).agg(F.count(F.lit(1)).alias("__n"), F.sum(size).alias("__bytes"))
    checks = {"over_limit": F.col("__bytes") > max_bytes}
    if declared is not None:
        named = declared.select(part, F.col("record_count").alias("__count"), F.col("byte_size").alias("__size"))
        actual = actual.join(named, part, "full")
        checks |= {
            "not_in_manifest": F.col("__count").isNull() & F.col("__n").isNotNull(),
            "missing_part": F.col("__n").isNull(),
            "record_count_mismatch": F.col("__n") != F.col("__count"),
            "byte_size_mismatch": F.col("__bytes") != F.col("__size"),
        }
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return actual.select(part, F.explode(found).alias("fault"))


def priority_summary(
    queue: DataFrame, max_bytes: int, priority: str = "priority", size: str = "line_bytes", shown: Sequence[str] = ("P0", "P1")
) -> DataFrame:
    """Counts and bytes of the shown priorities, one row each (zero where none occurs), the bytes of all of
    them together and whether these fit into one part."""
    spark = queue.sparkSession
    counted = queue.where(F.col(priority).isin(*shown)).groupBy(priority).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(size).cast("long").alias("byte_size")
    )
    names = spark.createDataFrame([(p,) for p in shown], f"{priority} string")
    zero = F.lit(0).cast("long")
    rows = names.join(counted, priority, "left").select(
        priority, F.coalesce("record_count", zero).alias("record_count"), F.coalesce("byte_size", zero).alias("byte_size")
    )
    whole = counted.agg(F.coalesce(F.sum("byte_size"), zero).alias("summary_bytes"))
    return rows.crossJoin(whole).withColumn("fits", F.col("summary_bytes") <= max_bytes)  # ``whole`` is one row


def summary_faults(summary: DataFrame, priority: str = "priority", shown: Sequence[str] = ("P0", "P1")) -> DataFrame:
    """Rows of a published summary that have another priority, or none."""
    return summary.where(~F.coalesce(F.col(priority).isin(*shown), F.lit(False)))
