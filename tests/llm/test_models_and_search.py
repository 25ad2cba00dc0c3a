"""Language ID, quality, neighbours, urls and licences: edge cases and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id as lid
from tidemark.llm import license_scan as ls
from tidemark.llm import neighbours as nb
from tidemark.llm import quality as ql
from tidemark.llm.byte_gru import WIDTH, ByteGru, windows_of
from tidemark.llm.queries import LICENSE_NOTICES, QUERIES, SIBLING_NOTICES, URL_RULES, _sql_licenses
from tidemark.llm.url_filter import judge_urls

# language ID


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = ByteGru.fresh(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows, labels = rng.integers(97, 110, (4, 12)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grad = net.gradients(windows, labels)
    for name, values in net.p.items():
        at = np.unravel_index(np.argmax(np.abs(grad[name])), values.shape)
        old, losses = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = old + step
            losses.append(net.gradients(windows, labels)[0])
        values[at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - grad[name][at]) < 1e-6


def test_prediction_runs_the_trained_steps():
    """Pooled probabilities equal those of the step that training differentiates."""
    rng = np.random.default_rng(2)
    net = ByteGru.fresh(["a", "b"])
    windows = rng.integers(0, 256, (3, WIDTH)).astype(np.uint8)
    lengths = np.array([WIDTH, 7, 1])
    states = {}
    for d in "fb":
        h = np.zeros((3, net.p["uf"].shape[0]), np.float32)
        for t in range(WIDTH) if d == "f" else range(WIDTH - 1, -1, -1):
            h, _ = net._step(d, h, windows[:, t])
            states[d, t] = h
    want = np.zeros((3, 2))
    for t in range(WIDTH):
        e = np.exp(states["f", t] @ net.p["vf"] + states["b", t] @ net.p["vb"] + net.p["o"])
        want += (e / e.sum(axis=1, keepdims=True)) * (lengths > t)[:, None]
    assert np.allclose(net.window_sums(windows, lengths), want, atol=1e-3)


def test_windows_cover_whole_texts():
    windows, lengths, counts = windows_of([b"", b"x" * WIDTH, b"y" * (WIDTH + 1)])
    assert counts.tolist() == [0, 1, 2] and lengths.tolist() == [WIDTH, WIDTH, 1]
    assert windows.shape == (3, WIDTH)


def test_language_of_held_out_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "12 ; 3", "en", "s", 0), (-4, "a", None, "s", 0)], docs.schema
    )
    docs = docs.unionByName(odd).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit("clash"))
    rows = lid.identify(docs).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.doc_id >= 0 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    by = {r.doc_id: r for r in rows}
    assert [by[-i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[-4].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lid.identify(docs).collect()] == [("und", 0.0)]
    assert lid.identify(docs.where("false")).count() == 0


# quality


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.6])
    votes = np.where(rng.random((20000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = ql.ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = ql.LabelModel.fit(patterns, counts.astype(float))
    assert np.abs(model.accuracies() - right).max() < 0.04 and abs(model.good - 0.7) < 0.05


def test_quality_against_held_labels(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, " \n ", "en", "s", 0)], docs.schema)
    rows = ql.score_quality(docs.unionByName(odd).withColumn("votes", F.lit(1))).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() + 2 and by[-1].score == by[-2].score == 0 and not by[-1].kept
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").collect()
    good = [by[r.doc_id] for r in labels if r.quality == 1]
    bad = [by[r.doc_id] for r in labels if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.9
    assert np.mean([g.score > b.score for g in good for b in bad]) > 0.85
    assert ql.score_quality(docs.where("false")).count() == 0


# neighbours


def brute_nearest(ids, x, q, k):
    norms = np.sqrt((x * x).sum(axis=1))
    score = (x * x[q]).sum(axis=1) / (norms * norms[q])
    order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
    return [(int(ids[i]), score[i]) for i in order]


@pytest.mark.parametrize("group", [(nb.CANDIDATES, nb.QUERIES), (40, 7)])
def test_neighbours(spark, monkeypatch, group):
    """Exact when every list is probed; also when lists are split into many groups."""
    monkeypatch.setattr(nb, "CANDIDATES", group[0])
    monkeypatch.setattr(nb, "QUERIES", group[1])
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 24)).astype(np.float32)
    x[200:400] = x[200]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1050, [0.0] * 24), (1100, [float("nan")] * 24), (1150, [float("inf")] * 24), (1200, [None] * 24), (1250, [1.0])]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows + odd], "vec_id long, embedding array<float>, score double")
    got = {}
    for r in nb.nearest(frame, F.col("vec_id") % 50 == 0, probed=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 600, 50))
    ids, y, same = np.arange(600), x.astype(np.float64), 0
    for q, found in got.items():
        want = brute_nearest(ids, y, q, 5)
        same += sum(found[i + 1][0] == want[i][0] for i in range(5))
        assert all(abs(found[i + 1][1] - brute_nearest(ids, y, q, 600)[[v for v, _ in brute_nearest(ids, y, q, 600)].index(found[i + 1][0])][1]) < 1e-12 for i in range(5))
    assert same >= 0.95 * 60
    assert [got[250][i][0] for i in range(1, 6)] == [200, 201, 202, 203, 204]  # ties to the smaller id
    assert nb.nearest(frame.where("false"), F.col("vec_id") == 0).count() == 0
    few = nb.nearest(frame.where("vec_id in (0, 7)"), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(0, 7)]
    assert nb.nearest(frame.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_recall_at_the_production_share(spark, sf_small):
    frame = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in nb.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[int(ids[q])] & {v for v, _ in brute_nearest(ids, x, q, 5)}) for q in np.flatnonzero(ids % 50 == 0))
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_lists_and_share_follow_the_data(spark):
    """Vectors in clusters get more lists than vectors without structure, of which few are looked into."""
    rng = np.random.default_rng(6)
    loose = nb._unit(rng.normal(size=(6000, 32)))
    tight = nb._unit(rng.normal(size=(400, 32))[rng.integers(0, 400, 40_000)] + 0.1 * rng.normal(size=(40_000, 32)))
    found, share = nb.fitted_lists(loose, 1_000_000, 5, None)
    assert len(found) <= 375 and share > 0.3
    many, small = nb.fitted_lists(tight[:16_384], 40_000, 5, None)
    assert len(many) > nb.LEAST_LISTS and small < 0.1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(tight[:4000])], "vec_id long, embedding array<double>")
    got = {}
    for r in nb.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ids = np.arange(4000)
    hits = sum(len(got[q] & {v for v, _ in brute_nearest(ids, tight[:4000], q, 5)}) for q in range(0, 4000, 50))
    assert hits >= 0.9 * 5 * 80


@pytest.mark.parametrize("n", [4, 5, 6, 7])
def test_few_vectors_have_all_neighbours(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 24))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in nb.nearest(frame, F.col("vec_id") >= 0).collect()]
    ids = np.arange(n)
    assert sorted(got) == [(q, i + 1, v) for q in range(n) for i, (v, _) in enumerate(brute_nearest(ids, x, q, 5))]


def test_hot_copies_at_the_production_share(spark):
    """Copies take one list only, so the other queries look into their share of the rest."""
    x = np.random.default_rng(4).normal(size=(600, 24)).astype(np.float32).astype(np.float64)
    x[200:400] = x[200]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert len(np.unique((unit @ nb.centres(unit, nb.LEAST_LISTS).T).argmax(axis=1))) == nb.LEAST_LISTS
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nb.nearest(frame, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 600, 10)) and all(sorted(f) == [1, 2, 3, 4, 5] for f in got.values())
    kth = {q: brute_nearest(np.arange(600), x, q, 5)[-1][1] for q in got}
    hits = sum(score >= kth[q] - 1e-12 for q, found in got.items() for _, score in found.values())
    assert hits >= 0.9 * 5 * len(got)


def test_scan_keeps_k_candidates():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.normal(size=(12, 64)) * 0.7 ** np.arange(64)  # nearly all of a distance is in the first block
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        assert len(nb.scan(x[0], [x[:, i : i + 8] for i in range(0, 64, 8)], 5, 0)) >= 5


# urls


def test_url_rules_and_propagation(spark):
    rows = [
        (1, "http://a.org/x", '<a href="http://B.org/y">'),
        (2, "http://b.org/", "<a href=//c.net/es/1>"),
        (3, "http://c.net/es/q?z", '<a href="/here">'),
        (4, None, None),
        (5, "nothing", ""),
        (6, "HTTP://WWW.Example.COM/en/x#y", "<A HREF='https://friend.org'>"),
        (7, "http://com", None),
        (8, "http://u://v.com/EN/", None),
        (9, "https://friend.org?q=/", None),
        (10, "http://sub.example.com/en/", None),
        (10, "http://sub.example.com/en/", None),
        (11, "http://notexample.com/en/", None),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, URL_RULES).collect()}
    assert judge_urls(pages, URL_RULES).count() == len(rows)
    assert got == {
        1: ("a.org", "/x", None, "block"),  # links to one that links to a blocked host
        2: ("b.org", "/", None, "block"),
        3: ("c.net", "/es/q", "net/es/", "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        7: ("com", "", None, "allow"),
        8: ("u:", "//v.com/EN/", None, "allow"),
        9: ("friend.org", "", None, "allow"),
        10: ("sub.example.com", "/en/", "example.com/en/", "block"),
        11: ("notexample.com", "/en/", "com/", "allow"),
    }
    assert judge_urls(pages.where("false"), URL_RULES).count() == 0


def test_ranks_equal_power_iteration(spark):
    rng = random.Random(7)
    hosts = [f"h{i}.org" for i in range(12)] + ["bad.net", "good.com"]
    links = [(rng.choice(hosts), rng.choice(hosts)) for _ in range(60)]
    pages = [(i, f"http://{a}/{'es' if a == 'bad.net' else 'en'}/", f'<a href="http://{b}/">') for i, (a, b) in enumerate(links)]
    pages += [(1000, "http://bad.net/es/", None), (1001, "http://good.com/", None)]
    got = {r.host: (r.trust, r.distrust) for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()}
    n, at = len(hosts), {h: i for i, h in enumerate(hosts)}
    w = np.zeros((n, n))
    for a, b in links:
        if a != b:
            w[at[a], at[b]] += 1
    share = lambda m: np.divide(m, m.sum(axis=1, keepdims=True), out=np.zeros_like(m), where=m.sum(axis=1, keepdims=True) > 0)
    for side, seed, matrix in ((0, "good.com", share(w)), (1, "bad.net", share(w.T))):
        start = np.zeros(n)
        start[at[seed]] = 1
        rank = start
        for _ in range(12):
            rank = 0.15 * start + 0.85 * rank @ matrix
        assert all(abs(got[h][side] - rank[at[h]]) < 1e-9 for h in hosts if h in got)


def test_walks_go_on_until_settled(spark, tmp_path):
    """A chain of 20 hosts to a blocked one, and two hosts that link to each other."""
    hosts = [f"h{i}.org" for i in range(20)]
    pages = [(i, f"http://{a}/", f'<a href="http://{b}/">') for i, (a, b) in enumerate(zip(hosts, [*hosts[1:], "bad.net"], strict=True))]
    pages += [(20, "http://bad.net/es/", None), (21, "http://good.com/", '<a href="http://x.org/">')]
    pages += [(22, "http://x.org/", '<a href="http://y.org/">'), (23, "http://y.org/", '<a href="http://x.org/">')]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.host: r for r in QUERIES["op3_url_filter"](spark, str(tmp_path)).collect()}
    for i, h in enumerate(hosts):
        assert got[h].verdict == "block" and abs(got[h].distrust - 0.15 * 0.85 ** (20 - i)) < 1e-9
    # x = 0.85 * (0.15 + y), y = 0.85 * x in the limit
    assert abs(got["x.org"].trust - 0.1275 / (1 - 0.7225)) < 2e-6 and got["y.org"].verdict == "allow"


# licences


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    filler = " ".join(f"word{i}" for i in range(500))
    rows = [
        (1, None),
        (2, ""),
        (3, "Released under"),
        (4, f"{filler} RELEASED UNDER the mit license! {filler}"),
        (4, f"{filler} RELEASED UNDER the mit license! {filler}"),
        (5, f"{filler}\n{mit.replace('charge', 'fee')}\n{filler}"),
        (6, "released the license under MIT"),
        (7, "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3."),
        (8, filler),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, license string")
    got = sorted((r.doc_id, r.license, round(r.containment, 2)) for r in ls.find_licenses(docs, LICENSE_NOTICES).collect())
    assert got == [(4, "MIT", 1.0), (7, "CC-BY-NC-4.0", 1.0), (7, "GPL-3.0", 1.0)] or got == [
        (4, "MIT", 1.0),
        (5, "MIT", 0.79),
        (7, "CC-BY-NC-4.0", 1.0),
        (7, "GPL-3.0", 1.0),
    ]
    loose = {(r.doc_id, r.license) for r in ls.find_licenses(docs, LICENSE_NOTICES, contained=0.7).collect()}
    assert (5, "MIT") in loose
    assert ls.find_licenses(docs.where("false"), LICENSE_NOTICES).count() == 0


def test_sibling_licences(spark):
    """Every notice, alone and beside another, names its own licence and no sibling."""
    notices = LICENSE_NOTICES + SIBLING_NOTICES
    pad = " ".join(f"word{i}" for i in range(40))
    gpl = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{}"
    later = ", or (at your option) any later version. "
    written_out = [
        ("GPL-2.0", gpl.format("General Public License", "; either version 2 of the License" + later)),
        ("GPL-2.0", gpl.format("General Public License", "; either version 2 of the Licence" + later)),
        ("GPL-3.0", gpl.format("General Public License", ", either version 3 of the License" + later)),
        ("LGPL-2.1", gpl.format("Lesser General Public License", "; either version 2.1 of the License" + later)),
        ("LGPL-3.0", gpl.format("Lesser General Public License", ", either version 3 of the License" + later)),
        ("AGPL-3.0", gpl.format("Affero General Public License", ", either version 3 of the License" + later)),
    ]
    texts = [({name}, f"{pad[: 7 * i]} {text}. {pad}") for i, (name, text) in enumerate(notices + written_out)]
    both = [(n, t) for n, t in notices if t.startswith("This work")]
    texts += [({a, b}, f"{s}. {t}.") for a, s in both for b, t in both if a != b]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(spark.createDataFrame([(-1, t) for _, t in notices], docs.schema))  # rows of one id do not compete
    got = {}
    for r in ls.find_licenses(docs, notices).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    import duckdb  # the registered SQL knows the same siblings

    con = duckdb.connect()
    con.execute("CREATE TABLE seeded (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO seeded VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(texts)])
    told = {i: set(x.split(",")) for i, x, _, _ in con.execute(_sql_licenses("seeded")).fetchall()}
    assert [(t, told[i], got.get(i)) for i, (_, t) in enumerate(texts) if told[i] != got.get(i)] == []
    assert got.pop(-1) == {n for n, _ in notices}
    assert [(t, got.get(i)) for i, (want, t) in enumerate(texts) if got.get(i) != want] == []
