"""The versioned table: late versions, replays and compaction."""

from __future__ import annotations

import json

from tidemark.streaming import jobs

SCHEMA = "id string, version int, body string"


def test_versions_over_batches(spark, tmp_path):
    source, rows, second = tmp_path / "in", str(tmp_path / "rows"), str(tmp_path / "fresh")
    source.mkdir()
    shape = spark.createDataFrame([], SCHEMA).schema

    def feed(name, items):
        (source / name).write_text("\n".join(json.dumps(dict(zip(shape.names, i, strict=True))) for i in items))
        stream = jobs.file_stream(spark, str(source), shape)
        jobs.run_to_end(lambda: jobs.upsert_latest(stream, rows, str(tmp_path / "log"), ["id"], ["version"]))

    assert jobs.latest_versions(spark, rows, shape, ["id"], ["version"]).count() == 0
    feed("a.json", [("x", 2, "x2"), ("x", 1, "x1"), ("y", 1, "y1")])
    feed("b.json", [("x", 1, "late"), ("y", 3, "y3"), ("z", 1, "z1")])
    want = [("x", 2, "x2"), ("y", 3, "y3"), ("z", 1, "z1")]
    assert sorted(map(tuple, jobs.latest_versions(spark, rows, shape, ["id"], ["version"]).collect())) == want
    jobs.compact(spark, rows, second, shape, ["id"], ["version"])
    assert sorted(map(tuple, jobs.latest_versions(spark, second, shape, ["id"], ["version"]).collect())) == want


def test_first_seen_over_batches_with_repeats_late_rows_and_a_freed_key(spark, tmp_path):
    import datetime as dt

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda minute: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=minute)
    schema = "id string, at timestamp, body string"
    deliveries = [
        [("x", at(1), "x1"), ("x", at(0), "x0"), ("y", at(1), "y1"), ("n", None, "no time")],  # the earliest of a batch
        [("x", at(2), "repeat"), ("z", at(3), "z3")],
        [("w", at(30), "w30")],  # moves the watermark; timers of x and y fire afterwards
        [("x", at(31), "x31"), ("y", at(5), "too late"), (None, at(32), "null key")],
        [("x", at(33), "repeat"), (None, at(34), "repeat")],
    ]
    for number, rows in enumerate(deliveries):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, spark.createDataFrame([], schema).schema, "parquet")
        jobs.run_to_end(lambda s=stream: jobs.append_all(jobs.first_seen(s, ["id"], "at", 600_000), out, str(tmp_path / "log")))
        if number == 2:
            jobs.run_to_end(lambda s=stream: jobs.append_all(jobs.first_seen(s, ["id"], "at", 600_000), out, str(tmp_path / "log")))
    got = sorted((r.id or "-", r.body) for r in spark.read.parquet(out).collect())
    assert got == [("-", "null key"), ("w", "w30"), ("x", "x0"), ("x", "x31"), ("y", "y1"), ("z", "z3")]


def test_first_seen_keeps_one_state_for_many_keys_and_frees_each_key_at_its_own_time(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = spark.createDataFrame([], "a long, b string, at timestamp, n long").schema
    when = "timestamp_seconds(1767225600 + {}) AS at"  # the first of January 2026

    def feed(select):
        spark.sql(select).coalesce(2).write.mode("append").parquet(source)
        states = []

        def start():
            stream = jobs.file_stream(spark, source, shape, "parquet")
            states.append(jobs.append_all(jobs.first_seen(stream, ["a", "b"], "at", 600_000, ["n"], groups=16), out, str(tmp_path / "log")))
            return states[0]

        jobs.run_to_end(start)
        return states[0].lastProgress["stateOperators"][0]["numRowsTotal"]

    keys = "IF(id % 1500 = 0, NULL, id % 1500) AS a, IF(id % 2 = 0, 'x', 'y') AS b"
    # 1,500 keys, three rows each; a key's earliest is its second row, and the last two tie in time
    first = feed(f"SELECT {keys}, {when.format('IF(id < 1500, 300, 0) + id % 2')}, IF(id < 3000, id, -id) AS n FROM range(4500)")
    # every second key is repeated, and as many others are new at 500 seconds
    second = feed(f"SELECT id AS a, 'x' AS b, {when.format(500)}, 1 AS n FROM range(2, 3000, 2)")
    got = {(r.a, r.b, r.n) for r in spark.read.parquet(out).collect()}
    old = {(k or None, "xy"[k % 2], -(3000 + k)) for k in range(1500)}
    new = {(k, "x", 1) for k in range(1500, 3000, 2)}
    assert got == old | new
    assert spark.read.parquet(out).count() == len(old) + len(new)
    assert max(first, second) < 200  # one for a group, not for each of 2,250 keys
    # the watermark moves to 650 seconds: past the time of the first keys, before that of the later ones in their groups
    feed(f"SELECT CAST(-1 AS long) AS a, 'x' AS b, {when.format(1250)}, 1 AS n")
    feed(f"SELECT id AS a, 'x' AS b, {when.format(1251)}, 2 AS n FROM range(2, 3000, 2)")
    again = {(r.a, r.b, r.n) for r in spark.read.parquet(out).where("n = 2").collect()}
    assert again == {(k, "x", 2) for k in range(2, 1500, 2)}
