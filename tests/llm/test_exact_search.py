"""Exact search by segment statistics: bounds, brute force, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_search as es

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64):
        x = rng.integers(-300, 300, (50, size))
        exact, before = x @ x.T, np.inf
        for s in es.resolutions(size):
            bound = es.statistics(x, s) @ es.statistics(x, s).T
            assert (bound >= exact - 1e-6).all()
            if size == 64:
                assert (bound <= before + 1e-6).all()
            before = bound
    assert es.resolutions(64) == [1, 2, 4, 8, 16, 32] and es.resolutions(1) == [1] and es.resolutions(0) == []


def test_few_are_scored_where_vectors_have_structure(monkeypatch):
    rng = np.random.default_rng(2)
    centres = np.cumsum(rng.normal(size=(20, 64)), axis=1) * 40
    x = (centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 64)) * 5).astype(np.int64)
    scored, exact = [], es._exact
    monkeypatch.setattr(es, "_exact", lambda q, x, qi, ci: scored.append(len(qi)) or exact(q, x, qi, ci))
    ids = np.arange(2000)
    got = es.search_block(ids[:100], x[:100], np.full(100, -np.inf), ids, x, 5)
    assert len(got[0]) == 500 and sum(scored) < 0.2 * 100 * 2000


def brute(rows, k=5):
    known: dict = {}
    usable = [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64)) for i, v in rows if v is not None and i is not None
              and all(c is not None and np.isfinite(c) for c in v)]
    for qi, q in usable:
        if qi % 50 == 0:
            for ci, c in usable:
                if ci != qi and len(c) == len(q):
                    score = int((q * c).sum())
                    known.setdefault(qi, {})[ci] = max(score, known.get(qi, {}).get(ci, score))
    out = []
    for qi, found in known.items():
        for rank, (ci, score) in enumerate(sorted(found.items(), key=lambda p: (-p[1], p[0]))[:k], 1):
            out.append((qi, rank, ci, score))
    return sorted(out)


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    for clash in ("row", "c", "q", "vector", "least", "score", "rank"):
        df = df.withColumn(clash, F.lit("x"))
    found = es.top_products(df, F.col("vec_id") % 50 == 0, **options)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def test_equals_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in rng.normal(size=16).astype(np.float32)]) for i in range(700)]
    assert search(spark, rows, candidates=100, queries=4) == brute(rows)


def test_ties_copies_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(0, 300)]  # a third are copies: ties by id
    rows += [(i, [float(c) for c in rng.normal(size=3).astype(np.float32)]) for i in range(300, 500)]
    rows += [(500, None), (501, [None, 1.0, 1.0]), (502, [float("nan"), 1.0, 1.0]), (503, [float("inf"), 0.0, 0.0]), (None, same)]
    rows += [(550, [0.0, 0.0, 0.0]), (600, [1.0, 2.0]), (601, [3.0, 4.0]), (650, []), (651, []), (700, [1.0])]
    rows += [(50, same), (50, [4.0, 4.0, 4.0]), (7, [9.0, 9.0, 9.0]), (7, same), (7, same)]  # repeated ids
    want = brute(rows)
    assert search(spark, rows, candidates=64, queries=2) == want
    assert search(spark, rows) == want
    assert not [r for r in want if r[0] == 700] and [r for r in want if r[0] == 650] == [(650, 1, 651, 0)]


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_nothing_to_find(spark, rows):
    assert search(spark, rows) == []


def test_query_takes_the_table(spark, sf_small):
    from tidemark.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    found = QUERIES["op11_exact_topk"](spark, sf_small).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute(rows)
