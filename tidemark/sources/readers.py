"""Readers with fixed schemas. Nothing here infers a schema from the data."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import path_date
from tidemark.sources.payloads import METADATA_SCHEMA, canonical_sha256


def read_lines(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """JSON lines, strict: a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lines_tolerant(spark: SparkSession, path: str | Sequence[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines). Bad lines are kept apart, so their number is known."""
    rows = spark.read.text(path).withColumn("__row", F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__none"}))
    valid = F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{")
    filled = rows.where(F.trim("value") != "")
    return filled.where(valid).select("__row.*"), filled.where(~valid).select(F.col("value").alias("bad_line"))


def read_envelopes(spark: SparkSession, path: str, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(verified, rejected) raw snapshots: metadata, payload as variant, path and its date.

    A snapshot is verified when its parts are objects, its source is the expected one and
    the payload digest equals the recorded one. Files are found below ``path`` at any depth.
    """
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("raw_path"))
    )
    parts = files.select(
        "raw_path",
        F.from_json(F.get_json_object("value", "$.metadata"), METADATA_SCHEMA).alias("metadata"),
        F.get_json_object("value", "$.payload").alias("__payload"),
        F.try_variant_get(F.try_parse_json("value"), "$.payload", "variant").alias("payload"),
    )
    # get_json_object re-renders numbers; the digest needs the text as it was written.
    digest = canonical_sha256(F.col("__payload"))
    checked = parts.withColumn("payload_digest", digest).withColumn("path_date", path_date(F.col("raw_path")))
    reason = (
        F.when(F.col("metadata").isNull() | F.col("__payload").isNull(), F.lit("invalid_envelope"))
        .when(F.lit(source).isNotNull() & ~F.col("metadata.source").eqNullSafe(F.lit(source)), F.lit("unexpected_source"))
        .when(~F.col("payload_digest").eqNullSafe(F.col("metadata.payload_sha256")), F.lit("payload_hash_mismatch"))
    )
    checked = checked.withColumn("reject_reason", reason).drop("__payload")
    return (
        checked.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        checked.where(F.col("reject_reason").isNotNull()),
    )


def path_contract(envelopes: DataFrame) -> DataFrame:
    """Snapshots whose path disagrees with their metadata (time, record id, date folder)."""
    from tidemark.functions.coerce import instant, zone_text

    local = zone_text(instant(F.col("metadata.fetched_at")))
    stamp = F.regexp_replace(F.substring(local, 1, 19), r"[-:]", "")
    name = F.substring_index("raw_path", "/", -1)
    errors = F.array_compact(
        F.array(
            F.when(~name.startswith(stamp), F.lit("filename_timestamp_mismatch")),
            F.when(~name.endswith(F.concat(F.lit("_"), F.col("metadata.record_id"), F.lit(".json"))), F.lit("filename_record_id_mismatch")),
            F.when(~F.col("path_date").eqNullSafe(F.substring(local, 1, 10)), F.lit("partition_date_mismatch")),
        )
    )
    return envelopes.select("raw_path", errors.alias("path_errors")).where(F.size("path_errors") > 0)


def below(path: str | Column, root: str) -> Column:
    """A file's path below ``root``, whatever scheme and authority stand before it."""
    column = F.col(path) if isinstance(path, str) else path
    bare = re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "", root.rstrip("/"), flags=re.IGNORECASE)
    return F.substring_index(column, f"{bare}/", -1)


def read_table(
    spark: SparkSession, manifest: DataFrame, root: str, table: str, schema: str, glob: str = "*"
) -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of a JSON-lines table through its manifest (table_name, file, sha256).

    Files found below ``root`` meet their manifest entries in a join, so no list of files goes through the
    driver; a file's digest is taken of the very bytes that are parsed. Rows come from files whose digest is the
    one of the manifest. ``problems``: entries without a file, files of another digest, and lines that are no JSON
    object. Files must fit into a row, as parts of bounded size do; what no entry names is not read.
    """
    entries = manifest.where(F.col("table_name") == table).select("file", "sha256")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select(below("path", root).alias("file"), "content")
    )
    met = entries.join(files, "file", "left").withColumn(
        "problem",
        F.when(F.col("content").isNull(), F.lit("missing_file")).when(
            F.sha2("content", 256) != F.col("sha256"), F.lit("hash_mismatch")
        ),
    )
    lines = met.where(F.col("problem").isNull()).select(
        "file", F.explode(F.split(F.decode("content", "UTF-8"), "\r?\n")).alias("line")
    )
    lines = lines.where(F.trim("line") != "").withColumn("whole", F.try_parse_json("line").isNotNull() & F.trim("line").startswith("{"))
    rows = lines.where("whole").select(F.from_json("line", schema).alias("row")).select("row.*")
    bad = lines.where(~F.col("whole")).select("file", F.lit("invalid_line").alias("problem"))
    return rows, met.where(F.col("problem").isNotNull()).select("file", "problem").unionByName(bad)


def read_contract_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, bad files) of CSV files whose header must be exactly ``columns``; all text.

    Every file's own first line is checked (a byte-order mark is allowed). Rows of a file with
    another header are left out, and the file is listed with the header it has.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__line"),
    )
    headers = lines.where(F.col("__start") == 0).groupBy("file").agg(F.min_by("value", "__line").alias("header"))
    names = F.transform(F.split(F.regexp_replace("header", "^\ufeff", ""), ","), lambda x: F.trim(x))
    bad = headers.where(names != F.array(*[F.lit(c) for c in columns]))
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "true")
        .csv(path)
        .select(*[f"`{c}`" for c in columns], F.col("_metadata.file_path").alias("__file"))
    )
    return rows.join(bad.select(F.col("file").alias("__file")), "__file", "left_anti").drop("__file"), bad


def read_documents(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """Whole text files below a folder, with their paths."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 and size of every file below a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select("path", F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"))


def manifest_check(manifest: DataFrame, digests: DataFrame, root: str) -> DataFrame:
    """Manifest entries against the files found: ok, missing_file or hash_mismatch.

    Files are told apart by their path below ``root``, so equal names in two bundles do not meet.
    """
    found = digests.select(below("path", root).alias("file"), F.col("sha256").alias("__sha256"))
    joined = manifest.join(found, "file", "left")
    status = (
        F.when(F.col("__sha256").isNull(), F.lit("missing_file"))
        .when(F.col("__sha256") != F.col("sha256"), F.lit("hash_mismatch"))
        .otherwise(F.lit("ok"))
    )
    return joined.select("table_name", "file", status.alias("status"))
