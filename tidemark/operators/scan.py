"""Sensitive-data scan over text tables and nested documents.

Findings carry the location and the category, never the text found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.detect import DETECTORS, forbidden_field


def scan_text(df: DataFrame, keys: Sequence[str], text: str, detectors: dict | None = None) -> DataFrame:
    """One row per (key, category) over whole texts; one pass for all detectors."""
    chosen = detectors or DETECTORS
    value = F.col(text)
    found = F.array_compact(
        F.array(*[F.when(F.coalesce(d(value), F.lit(False)), F.lit(name)) for name, d in chosen.items()])
    )
    return df.select(*keys, F.explode(found).alias("category"))


def scan_field_names(df: DataFrame, keys: Sequence[str], names: str) -> DataFrame:
    """Forbidden field names in an array column of names."""
    rows = df.select(*keys, F.explode(names).alias("__name"))
    return rows.select(*keys, forbidden_field(F.col("__name")).alias("category")).where(F.col("category").isNotNull())


_FLATTEN = """
WITH RECURSIVE opened(key, location, field, v, under, outside) AS (
  SELECT key, '$', CAST(NULL AS STRING), v, CAST(NULL AS STRING), CAST(NULL AS STRING) FROM {documents}
  UNION ALL
  SELECT t.key, concat(t.location, CASE WHEN e.key IS NULL THEN '[]' ELSE '.*' END), e.key, e.value,
    coalesce(e.key, t.under), CASE WHEN e.key IS NULL THEN t.outside ELSE t.under END
  FROM opened AS t, LATERAL variant_explode(t.v) AS e)
SELECT key, location, inline(array_compact(array(
    CASE WHEN field IS NOT NULL THEN struct(field, CAST(NULL AS STRING) AS text) END,
    CASE WHEN schema_of_variant(v) = 'STRING' THEN struct(CAST(NULL AS STRING) AS field, variant_get(v, '$', 'string') AS text) END
  ))), under, outside AS outer
FROM opened"""


def flatten_documents(documents: DataFrame, key: str, variant: str) -> DataFrame:
    """(key, location, field, text, under, outer) rows of nested JSON documents.

    A member of an object is a row with its name as ``field``, and a string is a row with its ``text``.
    ``under`` is the nearest member name above a text, ``outer`` the one above that. Array positions are not part
    of the location.

    One recursive plan: each step opens the containers that the step before has found, and it ends when none is
    left, however deep documents are. Rows stay where their document was read; nothing is shuffled.
    """
    spark = documents.sparkSession
    for limit in ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit"):
        spark.conf.set(limit, "-1")  # the recursion ends by itself
    named = documents.select(F.col(key).alias("key"), F.col(variant).alias("v"))
    return spark.sql(_FLATTEN, documents=named).withColumnRenamed("key", key)


def scan_documents(documents: DataFrame, key: str, variant: str) -> DataFrame:
    """Field-name and text findings of nested documents.

    Texts that name fields, in lists of raw field names and in column descriptors, are
    checked as names too.
    """
    flat = flatten_documents(documents, key, variant)
    naming = (F.col("under") == "raw_field_names") | (
        F.col("under").isin("key", "index_name") & (F.col("outer") == "columns")
    )
    name = F.coalesce("field", F.when(naming, F.col("text")))
    names = flat.select(key, "location", forbidden_field(name).alias("category")).where(F.col("category").isNotNull())
    texts = scan_text(flat.where(F.col("text").isNotNull()), [key, "location"], "text")
    return names.unionByName(texts).distinct()


def finding_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("category").agg(F.count(F.lit(1)).alias("finding_count"))
