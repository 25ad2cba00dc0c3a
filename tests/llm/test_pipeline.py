"""Every stage of the pipeline against brute force on its own input, and the whole run."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_text_operators import brute_components, brute_lines, brute_passages
from tidemark.llm.common import written
from tidemark.llm.language_id import held_out


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, "s", 0), (-2, "", "en", "s", 0), (-3, "1 2 3", "en", "s", 0)], docs.schema)
    return written(docs.unionByName(odd), "all-documents")


def test_stages(spark, sf_small, documents):
    stages = dict(cp.STAGES)
    columns = documents.columns
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]

    known = written(stages["language_id"](spark, documents, sf_small), "s1")
    gone = {i for i, _ in rows_of(documents)} - {i for i, _ in rows_of(known)}
    assert known.columns == columns and {-1, -2, -3} <= gone and len(gone) <= 3 + 0.01 * documents.count()

    lines = written(stages["line_dedup"](spark, known, sf_small), "s2")
    want = brute_lines([(i, t, None) for i, t in rows_of(known)], 10)
    assert lines.columns == columns and rows_of(lines) == sorted((i, t) for i, _, _, t in want)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = written(stages["near_dedup"](spark, lines, sf_small), "s3")
    roots = brute_components([(i, t, None) for i, t in rows_of(lines)], 5, 80, 100)
    assert near.columns == columns
    assert [i for i, _ in rows_of(near)] == sorted(i for i, (_, root) in roots.items() if i == root)

    clean = written(stages["decontamination"](spark, near, sf_small), "s4")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert clean.columns == columns
    assert rows_of(clean) == [(i, t) for i, t in rows_of(near) if not brute_passages(t, items)[1]]

    packed = stages["packing"](spark, clean, sf_small).toPandas()
    assert set(packed.doc_id) == {i for i, _ in rows_of(clean)}
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all()


def test_run_and_empty_tables(spark, sf_small, documents):
    whole = cp.run(spark, sf_small).toPandas()
    total = whole.groupby("doc_id").length.sum()
    assert len(whole) and np.array_equal(total, whole.groupby("doc_id").doc_tokens.first())
    empty = documents.where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf_small).count() == 0


def test_documents_stay_without_any_language(spark, sf_small):
    """Null languages everywhere, or only in held-out documents, leave no network to judge by."""
    rows = [(i, t, None) for i, t in enumerate(["some text", "\u0436\u0438", "\u65e5\u672c", "1 2 ; 3", "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = docs.withColumn("lang", F.when(held_out(), F.lit("en")))
    for table in (docs, labelled):
        kept = cp.language_id(spark, table, sf_small)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


CLASHES = ["score", "lang_pred", "n_lines", "n_dropped", "n_hit", "items", "spans", "row", "component_id", "kept", "n_shingles", "Held_Out", "own_score", "place"]


def test_columns_of_the_caller_stay_and_rows_are_judged_as_rows(spark, tmp_path, sf_small):
    """Clashing columns, rows of one id, repeated rows and null ids through all stages."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    some = [r for r in docs.where("lang = 'en' AND length(text) > 1500").orderBy("doc_id").limit(3).collect()]
    words = some[0].text.split()
    passage = " ".join(words[40:60])
    spark.createDataFrame([(1, passage), (None, "one two three four")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [" ".join(some[1].text.split()[i : i + 90]) for i in (0, 100)]
    odd = [
        (9001, clean[0], "en", "dup", 1), (9001, clean[0], "en", "dup", 1),  # repeated rows: one stays
        (9002, clean[1], "en", "twin", 1), (9002, f"{clean[1]} {passage}", "en", "twin", 1),  # one id, one of them hit
        (None, passage + " " + " ".join(words[200:260]), "en", "null", 1),  # null id, hit
        (None, " ".join(some[2].text.split()[:90]), "en", "null", 1), (None, " ".join(some[2].text.split()[:90]), "en", "null", 1),
        (9003, None, "en", "none", 1), (9004, "", "en", "none", 1),
    ]
    table = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for i, c in enumerate(CLASHES):
        table = table.withColumn(c, F.concat(F.lit(f"{i}:"), F.coalesce("source", F.lit("-"))))
    state, columns = written(table, "clash"), table.columns
    for name, stage in cp.STAGES[:-1]:
        state = written(stage(spark, state, str(tmp_path)), name)
        assert state.columns == columns
        for i, c in enumerate(CLASHES):
            assert not state.where(F.col(f"`{c}`") != F.concat(F.lit(f"{i}:"), F.coalesce("source", F.lit("-")))).count(), (name, c)
        if name == "language_id":
            assert {r.source for r in state.where("doc_id IN (9003, 9004)").collect()} == set()
    left = sorted((r.source, str(r.doc_id), r.text) for r in state.where("source IN ('dup', 'twin', 'null')").collect())
    assert left == [
        ("dup", "9001", clean[0]), ("null", "None", " ".join(some[2].text.split()[:90])), ("twin", "9002", clean[1]),
    ]
    assert cp.packing(spark, state, str(tmp_path)).count() >= state.count()
