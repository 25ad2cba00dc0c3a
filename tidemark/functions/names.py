"""Dynamic field names: ``base[context]`` split into base, date or report period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    FIELD_CONTEXT_PATTERN,
    FIELD_MAPPING_VERSION,
    FIELD_MAPPINGS,
    INDEX_FAMILIES,
    INDEX_NAME_NOISE,
    COMPACT_DATE_PATTERN,
    ISO_DATE_PATTERN,
    PERIOD_SUFFIXES,
    REPORT_LABEL_PATTERN,
    REPORT_LABELS,
)
from tidemark.functions.coerce import compact_date, iso_text

MAPPING_SCHEMA = (
    "base_field_name string, canonical_field_name string, category string, unit string, "
    "adjustment_type string, statement_type string, value_nature string"
)


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def mapping_rows(mappings: Sequence[tuple] = FIELD_MAPPINGS) -> list[tuple]:
    """One row per raw name. A raw name mapped twice is an error."""
    rows, seen = [], set()
    for canonical, category, raw_names, unit, adjustment, statement, nature in mappings:
        for raw in raw_names:
            if raw in seen:
                raise ValueError(f"raw field mapped twice: {raw}")
            seen.add(raw)
            rows.append((raw, canonical, category, unit, adjustment, statement, nature))
    return rows


def mapping_frame(spark: SparkSession, mappings: Sequence[tuple] = FIELD_MAPPINGS) -> DataFrame:
    return spark.createDataFrame(mapping_rows(mappings), MAPPING_SCHEMA)


def report_label_period(label: Column) -> Column:
    """Period end (ISO text) of a label such as ``2026年一季报``; null when not a label."""
    label = F.trim(label)
    ends = literal_map({k: v[0] for k, v in REPORT_LABELS.items()})
    return F.when(
        label.rlike(REPORT_LABEL_PATTERN),
        F.concat_ws("-", F.regexp_extract(label, REPORT_LABEL_PATTERN, 1), ends[F.regexp_extract(label, REPORT_LABEL_PATTERN, 2)]),
    )


def report_label_type(label: Column) -> Column:
    """Report type such as ``2026Q1``."""
    label = F.trim(label)
    suffixes = literal_map({k: v[1] for k, v in REPORT_LABELS.items()})
    return F.when(
        label.rlike(REPORT_LABEL_PATTERN),
        F.concat(F.regexp_extract(label, REPORT_LABEL_PATTERN, 1), suffixes[F.regexp_extract(label, REPORT_LABEL_PATTERN, 2)]),
    )


def period_report_type(period_end: Column) -> Column:
    """``2025-06-30`` to ``2025H1``; null for a day that ends no reporting period."""
    suffix = F.try_element_at(literal_map(PERIOD_SUFFIXES), F.substring(period_end, 6, 5))
    return F.concat(F.substring(period_end, 1, 4), suffix)


def is_period_end(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "MM-dd").isin(*PERIOD_SUFFIXES), F.lit(False))


def parse_field_names(
    names: DataFrame,
    mapping: DataFrame,
    name: str = "raw_field_name",
    mapping_version: str = FIELD_MAPPING_VERSION,
) -> DataFrame:
    """Parse every name of ``names`` and look its base up in ``mapping``.

    The mapping is configuration (one row per known alias), so it is broadcast. A context
    that looks like a date but is none gives ``parse_error``.
    """
    stripped = F.trim(F.col(name))
    has_context = stripped.rlike(FIELD_CONTEXT_PATTERN)
    out = names.withColumn(
        "base_field_name",
        F.when(has_context, F.trim(F.regexp_extract(stripped, FIELD_CONTEXT_PATTERN, 1))).otherwise(stripped),
    ).withColumn("original_context", F.when(has_context, F.trim(F.regexp_extract(stripped, FIELD_CONTEXT_PATTERN, 2))))
    context = F.col("original_context")
    dated = F.coalesce(context.rlike(COMPACT_DATE_PATTERN) | context.rlike(ISO_DATE_PATTERN), F.lit(False))
    day = iso_text(compact_date(F.regexp_replace(context, "-", "")))
    out = out.withColumn("__day", F.when(dated, day)).withColumn("__dated", dated)
    out = out.withColumn("__label", report_label_period(context)).withColumn("__label_type", report_label_type(context))
    out = out.join(mapping, "base_field_name", "left")
    mapped = F.col("canonical_field_name").isNotNull()
    financial = F.coalesce(F.col("category").isin("financial", "financial_metadata"), F.lit(False))
    as_period = financial & F.col("__day").isNotNull()
    kind = (
        F.when(context.isNull(), F.lit("none"))
        .when(as_period, F.lit("financial_period_date"))
        .when(F.col("__day").isNotNull(), F.lit("date"))
        .when(F.col("__label").isNotNull(), F.lit("report_period"))
        .otherwise(F.lit("unrecognized"))
    )
    out = out.withColumn("context_type", kind)
    out = out.withColumn("as_of_date", F.when(F.col("context_type") == "date", F.col("__day")))
    out = out.withColumn("period_end", F.when(as_period, F.col("__day")).otherwise(F.col("__label")))
    out = out.withColumn(
        "report_type", F.when(as_period, period_report_type(F.col("__day"))).otherwise(F.col("__label_type"))
    )
    confident = F.col("context_type").isin("date", "report_period", "financial_period_date")
    out = out.withColumn("mapping_status", F.when(mapped, F.lit("mapped")).otherwise(F.lit("unmapped")))
    out = out.withColumn(
        "confidence",
        F.when(mapped & confident, F.lit("high"))
        .when(mapped & (F.col("context_type") == "none"), F.lit("medium"))
        .otherwise(F.lit("low")),
    )
    out = out.withColumn(
        "parse_error",
        F.when(F.coalesce(stripped, F.lit("")) == "", F.lit("empty_name")).when(
            F.col("__dated") & F.col("__day").isNull(), F.lit("invalid_date_context")
        ),
    )
    return out.withColumn("mapping_version", F.lit(mapping_version)).drop("__day", "__dated", "__label", "__label_type")


def index_key(text: Column) -> Column:
    """Index name without spaces and separators, upper case."""
    return F.upper(F.regexp_replace(text, INDEX_NAME_NOISE, ""))


def index_family(tracked: Column, families: dict[str, list[str]] = INDEX_FAMILIES) -> Column:
    """First family, in configured order, one of whose aliases occurs in the name."""
    key = index_key(tracked)
    family = F.lit(None).cast("string")
    for name, aliases in reversed(list(families.items())):
        hit = F.lit(False)
        for alias in aliases:
            hit = hit | key.contains(index_key(F.lit(alias)))
        family = F.when(hit, F.lit(name)).otherwise(family)
    return F.when(F.length(F.trim(tracked)) > 0, family)


def camel_case(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)


def publish_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the allowed columns that exist, under their published camelCase names."""
    return df.select(*[F.col(c).alias(camel_case(c)) for c in columns if c in df.columns])
