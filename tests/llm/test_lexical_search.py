"""Lexical search by norm buckets against a plain recomputation, and its edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, lang string", "item_id long, text string"


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    bags = [(i, words(t)) for i, t in docs]
    n, total = sum(1 for _, w in bags if w), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    queries: dict = {}
    for i, t in set(items):
        queries.setdefault(i, Counter()).update(words(t))
    out = []
    for i, q in queries.items():
        scored = []
        for doc, w in bags:
            tf = Counter(w)
            m = 25 + (75 * len(w) * n) // total if total else 0
            score = sum(
                c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, c in q.items() if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if none else doc, -score))
    return sorted(out, key=repr)


def search(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "en") for i, t in docs], DOCS).repartition(4)
    b = spark.createDataFrame(items, ITEMS)
    for clash in ("n", "terms", "tf", "term", "length", "place", "row", "rank", "score"):
        d, b = d.withColumn(clash, F.lit("x")), b.withColumn(clash, F.lit("y"))
    found = lx.ranked_search(d, b, **options).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found), key=repr)


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(400)] + ["Straße", "ñandú", "x1"]
    pick = lambda m: " ".join(rng.choice(vocabulary[: 1 + int(403 * rng.random() ** 3)]) for _ in range(m))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(n)]
    return docs, [(i, pick(rng.randrange(1, 25))) for i in range(12)]


@pytest.mark.parametrize("seeds", [1, 40, 10_000])
def test_equals_recomputation(spark, monkeypatch, seeds):
    docs, items = corpus(random.Random(seeds), 600)
    items += [(50 + i, docs[i * 7][1]) for i in range(5)]
    assert search(spark, docs, items, seeds=seeds) == brute(docs, items)


def test_blocks_of_items(spark):
    docs, items = corpus(random.Random(5), 200)
    assert search(spark, docs, items, block_terms=40) == brute(docs, items)


def test_odd_rows_ties_and_copies(spark):
    docs, items = corpus(random.Random(6), 60)
    docs += [(1000 + i, "w3 W5 w5-w399") for i in range(40)]  # ties by id
    docs += [(2000, None), (2001, ""), (2002, " .;\n"), (None, "w3 w5"), (None, "w398"), (5, "w3"), (2003, "w1 " * 9000 + "ñandú")]
    items += [(100, None), (101, ""), (102, "..."), (103, "absent only"), (104, "W3 w3 w5"), (104, "W3 w3 w5"), (104, "ñandú"), (None, "w3 w398")]
    assert search(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(random.Random(7), 3)
    assert search(spark, [], items) == [] and search(spark, docs, []) == [] and search(spark, [(1, None)], items) == []


def test_terms_on_bytes_are_terms_of_text():
    text = "".join(map(chr, range(0x250))) + "Ünïcode_x y z 1A"
    assert [t.decode() for t in lx.terms_of(text.encode())] == words(text)


def test_buckets_are_left_out_and_documents_filtered(monkeypatch):
    rng = np.random.default_rng(8)
    terms = [np.sort(rng.choice(500, 12, replace=False)).astype(np.int32) for _ in range(4000)]
    impacts = [np.maximum(1, rng.integers(1, 1000, 12) * (2 if i < 400 else 1)).astype(np.int32) for i in range(4000)]
    lengths = np.array([math.sqrt(float((v.astype(float) ** 2).sum())) for v in impacts])
    order = np.argsort(-lengths)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(order.astype(np.int64)), "length": pa.array(lengths[order]),
        "terms": pa.array([terms[i] for i in order]), "impacts": pa.array([impacts[i] for i in order]),
    })
    scored, exact = [], lx.Bucket.exact
    monkeypatch.setattr(lx.Bucket, "exact", lambda self, found, t, w: scored.append(len(found)) or exact(self, found, t, w))
    queries = lx.Queries([terms[order[0]]], [np.full(12, 1000, np.int64)])
    ids, scores = lx.best_of(iter([batch]), queries, np.zeros(1, np.int64), 10)
    dense = np.zeros(500, np.int64)
    dense[queries.terms[0]] = 1000
    want = sorted(((-int((dense[t] * v).sum()), i) for i, (t, v) in enumerate(zip(terms, impacts, strict=True))))[:10]
    assert [(-int(s), int(i)) for i, s in zip(ids[0], scores[0], strict=True)] == want
    assert sum(scored[1:]) < 400  # of about 2000 in the second bucket
