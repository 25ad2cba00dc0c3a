"""Ranks, previous rows and running sums over a global or very large group order.

``Window.orderBy`` without a partition sends every row to one task, and a window over a
group that holds a third of the table sends that third to one task. Here the rows are
range-partitioned on (group, order) instead, so a hot group spreads over many tasks, and
settled once in the shared folder. A second pass reads one small row per (partition,
group) and adds the partition's offset to each row's local position.

The order must end in a unique key; otherwise ties have no defined position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

_ROW = "__row"
_PART = "__part"
_LOCAL_BITS = 33


def _as_column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item


def lay_out(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Range-partition and sort on (by, order), settle, and number the rows.

    ``__part`` is the partition and ``__row`` increases along the global order.
    """
    keys = [F.col(c).asc_nulls_first() for c in by] + [_as_column(o) for o in order]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_ROW, F.monotonically_increasing_id())
    # Numbers are written with the rows, so reading them in other partitions changes nothing.
    return settle(laid.withColumn(_PART, F.shiftright(F.col(_ROW), _LOCAL_BITS).cast("int")))


def _attach(laid: DataFrame, per_part: DataFrame, by: Sequence[str], bounded: bool) -> DataFrame:
    """Join the per-(partition, group) facts back; group columns may be null."""
    renamed = per_part.select(
        *[F.col(c).alias(f"__r_{c}") if c in (*by, _PART) else F.col(c) for c in per_part.columns]
    )
    if bounded:  # one row for each partition
        renamed = F.broadcast(renamed)
    condition = F.col(_PART) == F.col(f"__r_{_PART}")
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return laid.join(renamed, condition, "left").drop(f"__r_{_PART}", *[f"__r_{c}" for c in by])


def ranked(
    df: DataFrame,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    rank: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """Exact ``row_number`` (and optionally group size) without one task per group."""
    by = list(by)
    laid = lay_out(df, by, order)
    per_part = laid.groupBy(*by, _PART).agg(F.min(_ROW).alias("__first"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*by)
    before = group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")))
    if size:
        per_part = per_part.withColumn("__size", F.sum("__n").over(group))
    out = _attach(laid, per_part, by, bounded=not by)
    out = out.withColumn(rank, F.col(_ROW) - F.col("__first") + F.col("__before") + F.lit(1).cast("long"))
    if size:
        out = out.withColumn(size, F.col("__size"))
    return out.drop(_ROW, _PART, "__first", "__n", "__before", "__size")


def percentile_scores(
    df: DataFrame,
    value: str,
    key: str,
    direction: str = "higher",
    by: Sequence[str] = (),
    score: str = "percentile_score",
) -> DataFrame:
    """Position / (n - 1) in (value, key) order; equal values get different scores."""
    out = ranked(df, [F.col(value).asc(), F.col(key).asc()], by=by, rank="__rank", size="__count")
    position = (F.col("__rank") - 1).cast("double") / F.nullif(F.col("__count") - 1, F.lit(0)).cast("double")
    directed = F.lit(1.0) - position if direction == "lower" else position
    return out.withColumn(
        score, F.when(F.col("__count") == 1, F.lit(1.0)).otherwise(directed)
    ).drop("__rank", "__count")


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str],
    prefix: str = "prev_",
) -> DataFrame:
    """``lag`` by one inside each group, with hot groups spread over many tasks.

    Each partition lags locally; its first row takes the last row of the partition
    before it, from a table with one row per partition.
    """
    by = list(by)
    laid = lay_out(df, by, order)
    carried = F.struct(*[F.col(c) for c in by], *[F.col(c) for c in columns], F.lit(True).alias("__seen"))
    local = Window.partitionBy(_PART).orderBy(_ROW)
    out = laid.withColumn("__local", F.lag(carried).over(local))
    ends = laid.groupBy(_PART).agg(F.max_by(carried, F.col(_ROW)).alias("__end"))
    ends = ends.select(_PART, F.lag("__end").over(Window.orderBy(_PART)).alias("__edge"))
    out = _attach(out, ends, (), bounded=True)
    out = out.withColumn("__prev", F.coalesce(F.col("__local"), F.col("__edge")))
    same = F.col("__prev.__seen")
    for c in by:
        same = same & F.col(f"__prev.{c}").eqNullSafe(F.col(c))
    for c in columns:
        out = out.withColumn(f"{prefix}{c}", F.when(same, F.col(f"__prev.{c}")))
    return out.drop(_ROW, _PART, "__local", "__edge", "__prev")


def running_sum(
    df: DataFrame,
    order: Sequence[str | Column],
    value: str,
    total: str = "running_total",
) -> DataFrame:
    """Sum of ``value`` up to and including each row, over the whole table's order."""
    laid = lay_out(df, (), order)
    per_part = laid.groupBy(_PART).agg(F.sum(value).alias("__sum"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select(_PART, F.sum("__sum").over(before).alias("__before"))
    local = Window.partitionBy(_PART).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = laid.withColumn("__local", F.sum(value).over(local))
    out = _attach(out, per_part, (), bounded=True)
    zero = F.lit(0).cast("long")
    out = out.withColumn(total, F.coalesce(F.col("__before"), zero) + F.col("__local"))
    return out.drop(_ROW, _PART, "__local", "__before")


def byte_buckets(
    df: DataFrame,
    order: Sequence[str | Column],
    size: str,
    max_bytes: int,
    bucket: str = "bucket",
) -> DataFrame:
    """Number consecutive output parts so that no part exceeds ``max_bytes``.

    A bucket starts every ``max_bytes - largest row`` bytes of the running total, so a
    bucket's content is at most that stride plus its last row. A row over the limit is an
    error, as it can be placed nowhere.
    """
    largest = df.agg(F.max(size)).first()[0] or 0
    if largest > max_bytes:
        raise ValueError("one row is larger than the part limit")
    stride = max(max_bytes - largest, 1)
    out = running_sum(df, order, size, total="__through")
    start = F.col("__through") - F.col(size)
    return out.withColumn(bucket, F.floor(start / F.lit(stride)).cast("long") + 1).drop("__through")
