"""Versions, split proofs, manifests, bundles, routes, sets and published-set rules."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coerce import version_key
from tidemark.operators import coverage, jobs, proofs, quality, scan, sets
from tidemark.sources import readers, writers


# --- versions -----------------------------------------------------------------------
def test_version_order(spark):
    ordered = ["", "a", "a.b", "b", "1", "1-a", "1.0", "1.0.0", "1.0.1", "1.2", "1.010", "1.10.1", "2", "10.0", "99999999999999999999999", "100000000000000000000000"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(ordered)], "i int, v string")
    got = [r.v for r in rows.orderBy(version_key(F.col("v")), "i").collect()]
    assert got == ordered
    null = spark.range(1).select(version_key(F.lit(None).cast("string")).alias("k"), version_key(F.lit("")).alias("e")).first()
    assert null.k == null.e


def test_best_version_takes_date_then_versions_then_bundle(spark):
    rows = [("m", "2026-01-02", "1.9", "b1"), ("m", "2026-01-02", "1.10", "b2"), ("m", "2026-01-02", "1.10", "b3"), ("m", "2026-01-01", "9", "b4"), ("n", None, None, "b5")]
    frame = spark.createDataFrame(rows, "domain string, day string, parser string, bundle string")
    got = {r.domain: r.bundle for r in coverage.best_version(frame, ["domain"], "day", ["parser"], "bundle").collect()}
    assert got == {"m": "b3", "n": "b5"}


# --- nested documents ---------------------------------------------------------------
def test_flattened_documents(spark):
    document = {"a": {"b": ["x", {"c": "y"}], "n": None}, "e": [], "t": True, "k": 7}
    frame = spark.createDataFrame([(1, json.dumps(document)), (2, '"only"'), (3, None)], "id long, j string")
    flat = scan.flatten_documents(frame.select("id", F.try_parse_json("j").alias("v")), "id", "v").collect()
    got = sorted((r.id, r.location, r.field or "", r.text or "", r.under or "", r.outer or "") for r in flat)
    assert got == sorted([
        (1, "$.*", "a", "", "a", ""), (1, "$.*", "e", "", "e", ""), (1, "$.*", "k", "", "k", ""), (1, "$.*", "t", "", "t", ""),
        (1, "$.*.*", "b", "", "b", "a"), (1, "$.*.*", "n", "", "n", "a"), (1, "$.*.*[]", "", "x", "b", "a"),
        (1, "$.*.*[].*", "c", "", "c", "b"), (1, "$.*.*[].*", "", "y", "c", "b"), (2, "$", "", "only", "", ""),
    ])


# --- split exports ------------------------------------------------------------------
def test_multiset_digest_counts_repeats_and_tells_nulls(spark):
    def told(rows):
        return proofs.table_digests(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).first()

    base = [("x", "y"), ("x", None), ("", "z")]
    assert told(base) == told(base[::-1])
    assert len({told(r) for r in (base, [*base, base[0]], [("xy", ""), *base[1:]], [("x", "y"), ("x", ""), ("", "z")], [("x", "y"), (None, "x"), ("", "z")], [])}) == 6


def test_part_and_summary_faults(spark):
    parts = spark.createDataFrame([(1, 40), (1, 70), (2, 10), (4, 5)], "part long, line_bytes long")
    declared = spark.createDataFrame([(1, 2, 110), (2, 2, 11), (3, 1, 1)], "part long, record_count long, byte_size long")
    got = sorted(map(tuple, proofs.part_faults(parts, 100, declared=declared).collect()))
    assert got == [(1, "over_limit"), (2, "byte_size_mismatch"), (2, "record_count_mismatch"), (3, "missing_part"), (4, "not_in_manifest")]
    queue = spark.createDataFrame([("P0", 60), ("P0", 30), ("P2", 500), (None, 1)], "priority string, line_bytes long")
    rows = {r.priority: (r.record_count, r.byte_size, r.summary_bytes, r.fits) for r in proofs.priority_summary(queue, 90).collect()}
    assert rows == {"P0": (2, 90, 90, True), "P1": (0, 0, 90, True)}
    assert not proofs.priority_summary(queue, 89).first().fits
    assert proofs.summary_faults(queue).count() == 2


# --- manifests ----------------------------------------------------------------------
def test_manifest_round_trip_and_its_faults(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id long, name string")
    writers.write_shards(rows, f"{tmp_path}/bundle/t", "name")
    root = f"file://{tmp_path}/bundle"
    manifest = writers.table_manifest(spark, root, "t", folder="t")
    held = [tuple(r) for r in manifest.select("table_name", "file", "sha256", "byte_size").collect()]
    manifest = spark.createDataFrame(held, "table_name string, file string, sha256 string, byte_size long")
    assert all(f.startswith("t/shard=") for _, f, _, _ in held)
    for where in (root, f"{tmp_path}/bundle", f"{tmp_path}/bundle/"):
        checked = readers.manifest_check(manifest, readers.file_digests(spark, where, "part-*"), where)
        assert {r.status for r in checked.collect()} == {"ok"}
        read, problems = readers.read_table(spark, manifest, where, "t", "id long, name string", "part-*")
        assert sorted(map(tuple, read.collect())) == sorted((i, f"n{i}") for i in range(50)) and problems.count() == 0
    assert readers.read_table(spark, manifest, root, "other", "id long")[0].count() == 0
    files = sorted(f for _, f, _, _ in held)
    path = Path(f"{tmp_path}/bundle/{files[0]}")
    path.write_text(path.read_text() + "not json\n")
    path.with_name(f".{path.name}.crc").unlink()  # the file system's own checksum would stop the read first
    more = [*held, ("t", "t/none.json", "0" * 64, 1)]
    more = [(t, f, hashlib.sha256(Path(f"{tmp_path}/bundle/{f}").read_bytes()).hexdigest() if f == files[0] else d, n) for t, f, d, n in more]
    more = [(t, f, "1" * 64 if f == files[1] else d, n) for t, f, d, n in more]
    tampered = spark.createDataFrame(more, "table_name string, file string, sha256 string, byte_size long")
    read, problems = readers.read_table(spark, tampered, root, "t", "id long, name string", "part-*")
    assert sorted(map(tuple, problems.collect())) == sorted([(files[0], "invalid_line"), (files[1], "hash_mismatch"), ("t/none.json", "missing_file")])
    assert 0 < read.count() < 50


# --- bundles and routes -------------------------------------------------------------
def test_bundle_ids_in_any_order_and_of_many_members(spark):
    def wanted(version, members):
        text = "\0".join([*version, *(sorted(set(members)) or [""])])
        return hashlib.sha256(text.encode()).hexdigest()[:20]

    many = [f"m{i % 7000}" for i in range(21_000)]
    rows = [("a", m) for m in many] + [("b", "z"), ("b", "é"), ("b", "z"), ("b", None), ("c", None), (None, "x")]
    frame = spark.createDataFrame(rows, "bundle string, member string").repartition(7)
    got = {r.bundle: r.bundle_id for r in jobs.bundle_id(frame, ["bundle"], ["v", "1"], "member").collect()}
    assert got == {"a": wanted(["v", "1"], many), "b": wanted(["v", "1"], ["z", "é"]), "c": wanted(["v", "1"], []), None: wanted(["v", "1"], ["x"])}
    assert jobs.bundle_id(frame.where("false"), ["bundle"], ["v"], "member").count() == 0


def test_routes(spark):
    rules = [("exact", "full query", "r1"), ("prefix", "fu", "r2"), ("prefix", "full", "r3"), ("prefix", "x", "r4"), ("exact", "twice", "r5"), ("exact", "twice", "r6"), ("prefix", "", "r7")]
    texts = [("full query",), ("full other",), ("fun",), ("xyz",), ("twice",), ("none",), (None,), ("x",)]
    frame = spark.createDataFrame(texts, "q string")
    table = spark.createDataFrame(rules[:-1], "kind string, rule string, route string")
    got = {r.q: (r.route, r.route_error) for r in jobs.route_texts(frame, table, "q").collect()}
    assert got == {
        "full query": ("r1", None), "full other": (None, "matches_multiple_prefixes"), "fun": ("r2", None), "xyz": ("r4", None),
        "x": ("r4", None), "twice": (None, "matches_repeated_rules"), "none": (None, None), None: (None, None),
    }
    every = spark.createDataFrame(rules[-1:], table.schema)
    assert {r.route for r in jobs.route_texts(frame.where("q IS NOT NULL"), every, "q").collect()} == {"r7"}
    assert {r.route for r in jobs.route_texts(frame, table.where("false"), "q").collect()} == {None}
    assert [tuple(r) for r in jobs.repeated_rules(table).collect()] == [("exact", "twice", 2)]


# --- sets ---------------------------------------------------------------------------
def test_bitmaps_count_what_sets_count(spark):
    rows = [(f"b{i % 3}", i * i % 100_003 - 50) for i in range(3000)] + [("b0", 0), ("b0", None), ("b1", 32768), ("b1", 32769), ("b2", -(2**40)), ("b2", 2**40)]
    frame = spark.createDataFrame(rows, "bundle string, id long")
    bitmaps = sets.record_bitmaps(frame, ["bundle"], "id")
    held = {b: {i for x, i in rows if x == b and i is not None} for b in ("b0", "b1", "b2")}
    assert {r.bundle: r.record_count for r in sets.merged_counts(bitmaps, ["bundle"]).collect()} == {b: len(s) for b, s in held.items()}
    assert sets.merged_counts(bitmaps).first().record_count == len(set().union(*held.values()))
    new = {r.bundle: r.new_records for r in sets.new_records(bitmaps, "bundle").collect()}
    assert new == {"b0": len(held["b0"]), "b1": len(held["b1"] - held["b0"]), "b2": len(held["b2"] - held["b1"] - held["b0"])}


def test_set_relations(spark):
    data = {"a": [1, 2, 3, 3], "b": [2, 3], "c": [3, 2], "d": [9], "e": [3, 9, None]}
    frames = {n: spark.createDataFrame([(x,) for x in v], "k long") for n, v in data.items()}
    found = sets.memberships(frames, "k")
    got = {(r.left_source, r.right_source): (r.common, r.left_only, r.right_only, r.relation) for r in sets.set_relations(found, list(data)).collect()}
    for a in data:
        for b in data:
            if a != b:
                x, y = {v for v in data[a] if v is not None}, {v for v in data[b] if v is not None}
                assert got[a, b][:3] == (len(x & y), len(x - y), len(y - x))
    assert got["b", "c"][3] == "equal" and got["b", "a"][3] == "subset" and got["a", "b"][3] == "superset" and got["a", "d"][3] == "disjoint" and got["a", "e"][3] == "overlap"
    gap = found.where(sets.in_source(list(data), "a") & ~sets.in_source(list(data), "b"))
    assert [r.k for r in gap.collect()] == [1]


# --- fields, responses and published sets -------------------------------------------
def test_responses_and_declared_fields(spark):
    rows = [("t1", '{"a": 1, "b": [1, 2]}', ["a", "b"]), ("t1", '{"b":[1,2],"a":1}', ["b", "a"]), ("t2", '{"a": 1, "b": [2, 1]}', ["a", "a"]), ("t2", '{"a": "1"}', None), ("t3", "[]", ["a", ""])]
    frame = spark.createDataFrame(rows, "at string, j string, declared array<string>").withColumn("v", F.parse_json("j"))
    assert [(r["at"], r.copies) for r in quality.repeated_responses(frame, ["at"], "v").collect()] == [("t1", 2)]
    detected = frame.withColumn("detected", F.coalesce(F.json_object_keys("j"), F.array().cast("array<string>")))
    got = sorted((r["at"], r.fault) for r in quality.declared_field_faults(detected, ["at"], "declared", "detected").collect())
    assert got == [("t2", "declared_fields_differ"), ("t2", "declared_fields_differ"), ("t2", "declared_fields_invalid"), ("t2", "declared_fields_repeated"), ("t3", "declared_fields_differ"), ("t3", "declared_fields_invalid")]
    audit = quality.field_audit(frame, ["at"], "v").collect()
    assert {r["at"]: (r.documents, r.merged_schema) for r in audit}["t2"] == (2, "OBJECT<a: VARIANT, b: ARRAY<BIGINT>>")


@pytest.mark.parametrize("kind", ["screen", "fund"])
def test_published_sets(spark, kind):
    day = F.to_date(F.lit("2026-08-07"))
    if kind == "screen":
        rows = [("600001.SH", "2026-08-07"), ("300001.SZ", "2026-08-07"), ("600002.HK", "2026-08-07"), (None, "2026-08-07"), ("600003.SH", "x"), ("600004.SH", "2026-08-06"), ("600001.SH", "2026-08-07")]
        frame = spark.createDataFrame(rows, "security_code string, as_of_date string")
        got = quality.screen_set_faults(frame, day, ["SH", "SZ"], ["300", "301"])
        want = {("300001.SZ", "outside_universe"), ("600002.HK", "invalid_code"), (None, "invalid_code"), ("600003.SH", "invalid_date"), ("600004.SH", "date_mismatch"), ("600001.SH", "repeated_code")}
    else:
        good = ("510001.SH", "SH", "u", "1", "2026-08-07")
        rows = [good, ("510002.SH", "SZ", "u", "1", "2026-08-07"), ("510003.SH", "SH", "v", None, "2026-08-07"), ("510004.SH", "SH", "u", "1", None), ("510005.SH", "SH", "u", "1", "2026-08-08"), good]
        frame = spark.createDataFrame(rows, "etf_code string, exchange string, universe_id string, universe_version string, as_of_date string")
        got = quality.fund_set_faults(frame, "u", "1", ["SH", "SZ"], day)
        want = {("510002.SH", "invalid_code_or_exchange"), ("510003.SH", "universe_id_mismatch"), ("510003.SH", "universe_version_mismatch"), ("510004.SH", "invalid_date"), ("510005.SH", "date_mismatch"), ("510001.SH", "repeated_code_and_date")}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
