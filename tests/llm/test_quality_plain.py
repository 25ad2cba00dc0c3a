"""The quality classifier against a plain recomputation: votes, label model, scorer and scores."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

from tidemark.llm import quality as ql
from tidemark.llm.queries import QUERIES

MARKS = set(b"#*$%&^~|=<>{}\\!_@")


def is_letter(b: int) -> bool:
    return 65 <= b <= 90 or 97 <= b <= 122 or b >= 128


def plain_votes(text: bytes) -> str:
    words = text.split()
    n, size = len(words), max(1, len(text))
    letters = max(1, sum(map(is_letter, text)))
    counts: dict = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    top = sorted(counts.values())[::-1]
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = sum(1 for i, b in enumerate(text) if b in b".!?" and (i + 1 == len(text) or text[i + 1] in b" \t\n\r\x0b\x0c"))

    def pick(value, good, bad):
        return "1" if good[0] <= value <= good[1] else "0" if bad[0] <= value <= bad[1] else "2"

    return "".join([
        pick(sum(b in MARKS for b in text) / size, (0, 0.004), (0.02, 1)),
        pick(sum(65 <= b <= 90 for b in text) / letters, (0.002, 0.12), (0.3, 1)),
        pick(top[0] / n, (0, 0.12), (0.25, 1)) if n > 20 else "2",
        pick(len(counts) / n, (0.3, 1), (0, 0.12)) if n > 20 else "2",
        "0" if not lines else pick(1 - len(set(lines)) / len(lines), (0, 0.02) if len(lines) > 2 else (9, 9), (0.3, 1)),
        pick(letters / max(1, n), (3, 9), (12, math.inf)),
        pick(ends / max(1, n), (0.02, 0.25), (0, 0.004) if n > 100 else (9, 9)),
        pick(sum(b == 124 for b in text) / max(1, n), (0, 0), (0.1, math.inf)),
        pick(n, (40, math.inf), (0, 0)),
        pick(sum(top[:10]) / n, (0.1, 0.55), (0.8, 1)) if n > 60 else "2",
    ])


def plain_model(patterns: dict[str, int]) -> dict[str, float]:
    """Posterior of each vote pattern after sixty rounds."""
    post = {}
    for p in patterns:
        good, bad = p.count("1"), p.count("0")
        post[p] = 0.9 if bad == 0 else 0.6 if good > 3 * bad else 0.1
    for _ in range(60):
        total = sum(patterns.values())
        prior = (sum(post[p] * c for p, c in patterns.items()) + 1) / (total + 2)
        chance = {}
        for i in range(10):
            for side in (0, 1):
                row = [1 + sum((post[p] if side else 1 - post[p]) * c for p, c in patterns.items() if p[i] == v) for v in "012"]
                chance[i, side] = [x / sum(row) for x in row]
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(chance[i, 1][int(v)] / chance[i, 0][int(v)]) for i, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-min(50, max(-50, odds))))
    return post


def plain_features(text: bytes) -> tuple[list[int], list[float]]:
    words = text.split()
    counts: dict = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    held: dict = {}
    shapes: dict = {}
    for w, c in counts.items():
        place = zlib.crc32(w.lower()) % ql.BUCKETS
        held[place] = held.get(place, 0) + c
        shape = bytes(65 if 65 <= b <= 90 else 97 if is_letter(b) else 48 if 48 <= b <= 57 else b for b in w)
        key = b"\0" + shape[:1] + shape[-3:].lstrip(b"a")
        shapes[key] = shapes.get(key, 0) + c
    for s, c in shapes.items():
        place = zlib.crc32(s) % ql.BUCKETS
        held[place] = held.get(place, 0) + 4 * c
    n = max(1, len(words))
    places, values = [*held, ql.BUCKETS], [*(math.sqrt(c / n) for c in held.values()), 1 - len(counts) / n]
    length = max(1e-9, math.sqrt(sum(v * v for v in values)))
    return places, [v / length for v in values]


def test_scores_equal_a_plain_recomputation(spark, sf_small):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(docs) <= ql.SAMPLED  # so every document is learnt from
    voted = {i: plain_votes(t) for i, t in docs.items()}
    patterns: dict = {}
    for v in voted.values():
        patterns[v] = patterns.get(v, 0) + 1
    post = plain_model(patterns)
    rows = [(plain_features(t), post[voted[i]]) for i, t in docs.items()]
    rows.sort(key=lambda r: struct.pack(f"<{len(r[0][0])}q", *r[0][0]))
    weights, seen, bias = [0.0] * (ql.BUCKETS + 1), [0.1] * (ql.BUCKETS + 1), 0.0
    sigmoid = lambda x: 1 / (1 + math.exp(-min(50, max(-50, x))))
    rng = np.random.default_rng(9)
    for _ in range(12):
        for i in rng.permutation(len(rows)):
            (places, values), target = rows[i]
            miss = sigmoid(sum(weights[p] * v for p, v in zip(places, values, strict=True)) + bias) - target
            for p, v in zip(places, values, strict=True):
                seen[p] += (miss * v) ** 2
                weights[p] -= miss * v / math.sqrt(seen[p])
            bias -= 0.02 * miss
    found = QUERIES["op6_quality"](spark, sf_small).collect()
    assert len(found) == len(docs)
    for r in found:
        places, values = plain_features(docs[r.doc_id])
        want = sigmoid(sum(weights[p] * v for p, v in zip(places, values, strict=True)) + bias) if docs[r.doc_id].split() else 0.0
        assert r.votes == voted[r.doc_id] and abs(r.posterior - post[r.votes]) < 1e-9
        assert abs(r.score - want) < 1e-3 and (r.kept == (want >= ql.KEPT_FROM) or abs(want - ql.KEPT_FROM) < 1e-3)
