"""Vendor responses: locating tables in nested payloads without inferring a schema."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

METADATA_SCHEMA = (
    "source string, query string, fetched_at string, record_id string, schema_version int, "
    "payload_sha256 string, as_of_date string, raw_field_names array<string>, collection_method string, "
    "collector_name string, "
    "collection_job struct<job_id: string, request_version: int, expected_period_end: string, query_sha256: string>, "
    "collection_request struct<request_schema_version: int, page: int, limit: int>"
)
COMPONENT_COLUMNS = "component int, columns array<variant>, rows array<variant>, page int, page_limit int, code_count int"


@pandas_udf(StringType())
def canonical_sha256(payload: pd.Series) -> pd.Series:
    """SHA-256 of the canonical form: sorted keys, no spaces, text as it is, no NaN."""

    def digest(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            body = json.dumps(
                json.loads(text), ensure_ascii=False, allow_nan=False, separators=(",", ":"), sort_keys=True
            )
        except ValueError:
            return None
        return hashlib.sha256(body.encode("utf-8")).hexdigest()

    return payload.map(digest)


def table_components(envelopes: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per table component, over the three payload layouts.

    ``payload`` is a variant. Direct ``datas`` come first, then ``answer.components``,
    then ``data.answer[].txt[].content.components[]``; ``columns`` is null for the direct
    layout, whose names are the keys of its rows.
    """
    keep = [c for c in envelopes.columns if c != payload]
    p = F.col(payload)

    def get(v: F.Column, path: str, kind: str) -> F.Column:
        return F.try_variant_get(v, path, kind)

    direct = envelopes.select(
        *keep,
        F.lit(0).alias("layout"),
        F.lit(0).alias("component"),
        F.lit(None).cast("array<variant>").alias("columns"),
        get(p, "$.datas", "array<variant>").alias("rows"),
        get(p, "$.page", "int").alias("page"),
        get(p, "$.limit", "int").alias("page_limit"),
        get(p, "$.code_count", "int").alias("code_count"),
    ).where(F.col("rows").isNotNull())

    def listed(frame: DataFrame, layout: int) -> DataFrame:
        data = F.col("__component")
        return frame.select(
            *keep,
            F.lit(layout).alias("layout"),
            F.col("component"),
            get(data, "$.data.columns", "array<variant>").alias("columns"),
            get(data, "$.data.datas", "array<variant>").alias("rows"),
            get(data, "$.data.meta.page", "int").alias("page"),
            get(data, "$.data.meta.limit", "int").alias("page_limit"),
            F.coalesce(get(data, "$.data.meta.code_count", "int"), get(data, "$.data.meta.total", "int")).alias("code_count"),
        ).where(F.col("columns").isNotNull())

    answered = envelopes.select(
        *keep, F.posexplode(get(p, "$.answer.components", "array<variant>")).alias("component", "__component")
    )
    blocks = envelopes.select(*keep, F.posexplode(get(p, "$.data.answer", "array<variant>")).alias("__a", "__answer"))
    blocks = blocks.select(*keep, "__a", F.posexplode(get(F.col("__answer"), "$.txt", "array<variant>")).alias("__b", "__block"))
    blocks = blocks.select(
        *keep, "__a", "__b",
        F.posexplode(get(F.col("__block"), "$.content.components", "array<variant>")).alias("component", "__component"),
    )
    return direct.unionByName(listed(answered, 1)).unionByName(listed(blocks, 2))


def component_rows(components: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, position, entries map<string, variant>) of every table row."""
    return components.select(*keys, F.posexplode("rows").alias("position", "__row")).select(
        *keys, "position", F.try_variant_get("__row", "$", "map<string,variant>").alias("entries")
    )


def column_descriptors(components: DataFrame, keys: list[str]) -> DataFrame:
    """Column descriptors: given ones, or for the direct layout inferred from the rows.

    The type of an inferred column is that of its first value that is neither null nor
    blank, in row order.
    """

    def text(path: str) -> F.Column:
        return F.try_variant_get("__column", path, "string")

    given = components.where(F.col("columns").isNotNull()).select(*keys, F.explode("columns").alias("__column"))
    given = given.select(
        *keys,
        text("$.key").alias("key"),
        text("$.index_name").alias("index_name"),
        text("$.source").alias("source"),
        text("$.type").alias("type"),
        text("$.unit").alias("unit"),
        text("$.timestamp").alias("timestamp"),
    )
    direct = component_rows(components.where(F.col("columns").isNull()), keys)
    cells = direct.select(*keys, "position", F.explode("entries").alias("key", "__value"))
    shape = F.schema_of_variant("__value")
    kind = (
        F.when(shape == "BOOLEAN", F.lit("BOOL"))
        .when(shape.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit("DOUBLE"))
        .when(shape == "STRING", F.lit("STR"))
        .when(shape.startswith("ARRAY"), F.lit("LIST"))
        .otherwise(F.lit("DICT"))
    )
    filled = F.coalesce(shape != "VOID", F.lit(False)) & (F.coalesce(F.try_variant_get("__value", "$", "string"), F.lit("x")) != "")
    inferred = cells.groupBy(*keys, "key").agg(
        F.min_by(F.when(filled, kind), F.when(filled, F.col("position"))).alias("type"),
    )
    inferred = inferred.select(
        *keys,
        "key",
        F.col("key").alias("index_name"),
        F.lit("openapi").alias("source"),
        "type",
        F.lit("").alias("unit"),
        F.lit(None).cast("string").alias("timestamp"),
    )
    return given.unionByName(inferred)


def raw_field_names(components: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted field names of each response (a response has tens of columns)."""
    named = column_descriptors(components, keys).select(*keys, F.coalesce("key", "index_name").alias("__name"))
    return named.where(F.coalesce("__name", F.lit("")) != "").groupBy(*keys).agg(
        F.sort_array(F.collect_set("__name")).alias("raw_field_names")
    )
