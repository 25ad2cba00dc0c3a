"""Version resolution: latest, first, merged and sliced rows.

All of these are aggregations, so Spark combines rows before the shuffle and a key that
holds a large share of the table reaches its reducer as a few partial rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import join_checked


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType) or dtype.typeName() == "variant":
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _ordering(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str]) -> Column:
    """Given order, then every other orderable column, so that no tie is left open."""
    parts = [(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    rest = [f.name for f in df.schema.fields if f.name not in named and _orderable(f.dataType)]
    return F.struct(*parts, *[F.col(c).alias(f"r_{c}") for c in rest])


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], newest: bool) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if all(_orderable(kinds[c]) for c in rest):
        # The order holds every column, so its extreme is the row: one struct to compare and to carry.
        extreme = F.max if newest else F.min
        place = {o: f"o{i}" for i, o in enumerate(order) if isinstance(o, str)}
        held = {c: place.get(c, f"r_{c}") for c in rest}
        picked = df.groupBy(*keys).agg(extreme(_ordering(df, order, keys)).alias("__row"))
        return picked.select(*keys, *[F.col(f"__row.{held[c]}").alias(c) for c in rest]).select(*df.columns)
    chooser = F.max_by if newest else F.min_by
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*[F.col(c) for c in rest]), _ordering(df, order, keys)).alias("__row")
    )
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key."""
    return _pick(df, keys, order, newest=True)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row seen first per key (``order`` is the arrival position)."""
    return _pick(df, keys, order, newest=False)


def union_latest(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Merge the same table from several batches and keep the latest version."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return latest_by(merged, keys, order)


def known_at(df: DataFrame, available: str, as_of: Column) -> DataFrame:
    """Rows that could be known at ``as_of``."""
    return df.where(F.col(available) <= as_of)


def latest_then_gate(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], available: str, as_of: Column
) -> DataFrame:
    """Pick the latest row first, then flag it if it was not yet available.

    It never falls back to an older row; use :func:`latest_known` for that.
    """
    return latest_by(df, keys, order).withColumn("available", F.coalesce(F.col(available) <= as_of, F.lit(False)))


def latest_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], available: str, as_of: Column
) -> DataFrame:
    """True as-of selection: only rows available at ``as_of`` compete."""
    return latest_by(known_at(df, available, as_of), keys, order)


def latest_slice(df: DataFrame, domain: Sequence[str], date: str) -> DataFrame:
    """All rows of each domain that carry the domain's newest date."""
    newest = df.groupBy(*domain).agg(F.max(date).alias("__newest"))
    return (
        join_checked(df, newest, domain, "inner").where(F.col(date) == F.col("__newest")).drop("__newest")
    )


def _no_id(key: str) -> Column:
    return F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""


def without_id(df: DataFrame, key: str) -> DataFrame:
    """Rows that cannot be merged, as they have no id."""
    return df.where(_no_id(key))


def merge_duplicates(
    df: DataFrame, key: str, mergeable: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts) for rows that share an id.

    Identical copies collapse. Among ``mergeable`` text columns the longest text wins,
    then the smallest. Any other difference makes the id a conflict, listed with the
    names of the differing columns; conflicting ids are left out of ``merged``. Rows without
    an id are in neither, see :func:`without_id`.
    """
    df = df.where(~_no_id(key))
    fixed = [c for c in df.columns if c != key and c not in mergeable]
    aggregates = [F.count(F.lit(1)).alias("copies")]
    for c in mergeable:
        text = F.when(F.col(c).isNotNull(), F.struct((-F.length(c)).alias("shorter"), F.col(c).alias("text")))
        aggregates.append(F.min(text).alias(f"__m_{c}"))
    for c in fixed:
        # A struct is never null itself, so equal extremes mean equal values, nulls included.
        held = F.struct(F.col(c).alias("v"))
        aggregates += [F.min(held).alias(f"__lo_{c}"), F.max(held).alias(f"__hi_{c}")]
    grouped = df.groupBy(key).agg(*aggregates)
    grouped = grouped.withColumn(
        "conflict_fields",
        F.array_compact(
            F.array(
                F.lit(None).cast("string"),
                *[
                    F.when(~F.col(f"__lo_{c}").eqNullSafe(F.col(f"__hi_{c}")), F.lit(c))
                    for c in sorted(fixed)
                ],
            )
        ),
    )
    values = {c: F.col(f"__lo_{c}.v") for c in fixed} | {c: F.col(f"__m_{c}.text") for c in mergeable}
    merged = grouped.where(F.size("conflict_fields") == 0).select(
        *[F.col(key) if c == key else values[c].alias(c) for c in df.columns]
    )
    conflicts = grouped.where(F.size("conflict_fields") > 0).select(key, "copies", "conflict_fields")
    return merged, conflicts


def duplicate_text(df: DataFrame, key: str, text: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per distinct text: its SHA-256, the first key, the number of copies.

    Texts are told apart by digest and length, so what is shuffled is narrow however long they are;
    null texts are one row with a null digest.
    """
    first = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    told = df.select(F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).alias("__size"), key, first.alias("__first"))
    return told.groupBy("text_sha256", "__size").agg(
        F.min_by(key, "__first").alias(key), F.count(F.lit(1)).alias("copies")
    ).drop("__size")


def latest_quote(
    frames: Sequence[DataFrame],
    codes: Sequence[str] = ("security_code", "code", "fund_code"),
    prices: Sequence[str] = ("close", "latest_price", "price", "unit_net_value"),
    dates: Sequence[str] = ("trade_date", "as_of_date", "nav_date"),
) -> DataFrame:
    """Newest price per code over tables that name their columns differently."""
    from tidemark.functions.coerce import finite, listed_code

    projected = []
    for frame in frames:
        have = set(frame.columns)

        def pick(names: Sequence[str], kind: str, have: set[str] = have) -> Column:
            return F.coalesce(*[F.col(n).cast(kind) for n in names if n in have], F.lit(None).cast(kind))

        projected.append(
            frame.select(
                listed_code(pick(codes, "string")).alias("security_code"),
                finite(pick(prices, "double")).alias("close"),
                pick(dates, "string").alias("trade_date"),
                (F.coalesce(F.col("currency"), F.lit("CNY")) if "currency" in have else F.lit("CNY")).alias("currency"),
                (F.coalesce(F.col("source"), F.lit("repository")) if "source" in have else F.lit("repository")).alias("source"),
            )
        )
    merged = projected[0]
    for frame in projected[1:]:
        merged = merged.unionByName(frame)
    usable = merged.where(
        (F.coalesce(F.col("security_code"), F.lit("")) != "")
        & F.col("close").isNotNull()
        & (F.coalesce(F.col("trade_date"), F.lit("")) != "")
    )
    return latest_by(usable, ["security_code"], ["trade_date"])
