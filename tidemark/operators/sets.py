"""Exact set algebra over many sources: mergeable bitmaps and membership bits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- bitmaps of whole-number ids ----------------------------------------------------
def record_bitmaps(records: DataFrame, group: Sequence[str], identity: str) -> DataFrame:
    """(group, bucket, bitmap): the ids of each group, 32,768 to a bucket.

    A bundle's bitmaps are made once; when it is processed again, or another one comes, only its own are
    made anew, and all counts are merged from bitmaps without a look at the records. Ids are whole
    numbers, as near to each other as they can be; a null id is no record.
    """
    held = records.where(F.col(identity).isNotNull())
    return held.groupBy(*group, F.bitmap_bucket_number(identity).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(identity)).alias("bitmap")
    )


def merged_counts(bitmaps: DataFrame, group: Sequence[str] = (), count: str = "record_count") -> DataFrame:
    """Distinct ids of each group of bundles (or of all), from their bitmaps."""
    merged = bitmaps.groupBy(*group, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("__n"))
    return merged.groupBy(*group).agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias(count))


def new_records(bitmaps: DataFrame, order: str, group: Sequence[str] = ()) -> DataFrame:
    """Of each bundle, in the order of ``order``, the ids that no earlier bundle has.

    Each step or's the bitmaps of the bundles before, so the work is one window over bitmaps
    for each bucket.
    """
    from pyspark.sql.window import Window

    each = bitmaps.groupBy(*group, order, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    window = Window.partitionBy(*group, "bucket").orderBy(order)
    upto = F.bitmap_count(F.bitmap_or_agg("bitmap").over(window))
    before = F.bitmap_or_agg("bitmap").over(window.rowsBetween(Window.unboundedPreceding, -1))
    gained = each.withColumn("__new", upto - F.coalesce(F.bitmap_count(before), F.lit(0)))
    return gained.groupBy(*group, order).agg(F.sum("__new").cast("long").alias("new_records"))


# --- membership bits ----------------------------------------------------------------
def memberships(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(key, members): a bit for each source, in the order of ``sources``, that has the key.

    One aggregation of all sources; rows are combined before the shuffle. Every union, intersection, difference and
    gap is a condition on ``members``. Null keys are left out.
    """
    if len(sources) > 63:
        raise ValueError("at most 63 sources have a bit")
    frames = [
        df.where(F.col(key).isNotNull()).select(key, F.lit(1 << bit).cast("long").alias("members"))
        for bit, df in enumerate(sources.values())
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole.groupBy(key).agg(F.bit_or("members").alias("members"))


def in_source(sources: Sequence[str], name: str, members: str = "members") -> Column:
    return F.getbit(F.col(members), F.lit(list(sources).index(name))) == 1


def set_relations(found: DataFrame, sources: Sequence[str]) -> DataFrame:
    """For each ordered pair of sources: common keys, keys of the first only, and whether it is a subset or equal.

    ``found``: rows of :func:`memberships`. It is counted by bits first, so the pairs are made of
    at most one row for each combination of sources that occurs.
    """
    names = list(sources)
    by_bits = found.groupBy("members").agg(F.count(F.lit(1)).alias("keys"))
    pairs = [
        F.struct(
            F.lit(a).alias("left_source"), F.lit(b).alias("right_source"),
            in_source(names, a).alias("l"), in_source(names, b).alias("r"),
        )
        for a in names for b in names if a != b
    ]
    each = by_bits.select("keys", F.inline(F.array(*pairs)))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("keys"))), F.lit(0)).cast("long")
    left, right = F.col("l"), F.col("r")
    counted = each.groupBy("left_source", "right_source").agg(
        total(left & right).alias("common"), total(left & ~right).alias("left_only"), total(~left & right).alias("right_only")
    )
    relation = (
        F.when((F.col("left_only") == 0) & (F.col("right_only") == 0), F.lit("equal"))
        .when(F.col("left_only") == 0, F.lit("subset"))
        .when(F.col("right_only") == 0, F.lit("superset"))
        .when(F.col("common") == 0, F.lit("disjoint"))
        .otherwise(F.lit("overlap"))
    )
    return counted.withColumn("relation", relation)
