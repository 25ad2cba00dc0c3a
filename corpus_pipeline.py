"""The corpus pipeline: stages of the llm operators over ``documents``.

Each stage takes what the stage before has kept and returns the columns of documents; the
last returns the placed pieces of what is left. ``run`` writes every stage to the shared folder.

A stage needs the columns doc_id and text (the first one lang as well) and gives back every other column as it
was, whatever its name: verdicts never replace a caller's column. Rows are judged as rows: a null doc_id, rows that share one
and repeated rows are each kept or left out for their own text. Texts are read whole, and an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id as lid
from tidemark.llm.common import table, written
from tidemark.llm.decontamination import find_passages
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack

#: A document whose best language has less than this mean probability is rejected.
LEAST_SCORE = 0.35


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _apart(docs: DataFrame, verdicts: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` over ``docs`` whose own columns of the names of ``verdicts`` are out of its way."""
    own = {c: _free(docs, f"own_{c}") for c in docs.columns if c.lower() in verdicts}
    return stage(docs.withColumnsRenamed(own)).select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language that the network is sure enough of.

    The network learns from the documents outside the held-out third that have a language and
    a text. Where there is none, nothing can be judged, and all documents with a letter stay. A null or
    empty text has no letter; the language a row names is never asked.
    """
    network = lid.train(docs.where(~lid.held_out()))
    if network is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    sure = (F.col("lang_pred") != lid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _apart(docs, ["lang_pred", "score"], lambda d: lid.predict(d, network).where(sure))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least ten documents share; ``n_chars`` follows.

    A null text stays null. A document may lose all its lines and stays with an empty text.
    """

    def drop_lines(d: DataFrame) -> DataFrame:
        kept = dedup_lines(d)
        if "n_chars" in docs.columns:
            changed = F.col("n_dropped") > 0
            kept = kept.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
        return kept

    return _apart(docs, ["n_lines", "n_dropped"], drop_lines)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all documents without words.

    That of the smallest doc_id stays, null after all others; of equal ids, the one that comes first in the
    table. Copies are told apart by the row, so of repeated rows one stays.
    Five words and 0.8 are the values that stages on shingles have by default; ``op8_near_dedup`` has its own.
    """
    row = _free(docs, "row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).where("n_shingles > 0")
    members = found.select(F.col("doc_id").alias(row), "component_id").join(
        rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row).alias("place")), row
    )
    first = members.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col(f"place.{row}").alias(row))
    copies = members.select(row).join(first, row, "left_anti")
    return rows.join(copies, row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ten words of the benchmark, nor a shorter item as a whole.

    A row travels through the search as a whole, so rows of one id, or none, are judged each.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text")
    return find_passages(whole, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("doc_id.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The placed pieces of every document that is left."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: No SQL: the first stage is a trained network. Tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
