"""Inputs that earlier cuts and readers got wrong."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions.coerce import instant, variant_instant
from tidemark.functions.text import compact_text, markdown_summary
from tidemark.operators import content, normalize, scan
from tidemark.operators import metrics as m
from tidemark.plans import marts
from tidemark.sources import readers


def test_pretty_printed_envelope_is_one_snapshot(spark, tmp_path):
    path = tmp_path / "2026" / "08" / "08"
    path.mkdir(parents=True)
    (path / "a.json").write_text(json.dumps({"metadata": {"source": "s"}, "payload": {"x": [1, 2]}}, indent=2))
    (path / "b.json").write_text("{\n broken")
    good, bad = readers.read_envelopes(spark, str(tmp_path))
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert good.count() == 0 and reasons == ["invalid_envelope", "payload_hash_mismatch"]
    (path / "c.md").write_text("# Title\n\nline\n\nline two")
    assert [r.text.count("\n") for r in readers.read_documents(spark, str(tmp_path)).collect()] == [4]


def test_every_csv_header_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿code,name\n1,x\n2,y\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("name,code\nz,3\n")
    rows, bad = readers.read_contract_csv(spark, str(tmp_path), ["code", "name"])
    assert sorted(map(tuple, rows.collect())) == [("1", "x"), ("2", "y")]
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["b.csv"]


def test_equal_names_in_two_bundles_do_not_meet(spark, tmp_path):
    for name, text in (("one", "a"), ("two", "b")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "events.jsonl").write_text(text)
    digests = readers.file_digests(spark, str(tmp_path))
    known = {r.path.split("/")[-2]: r.sha256 for r in digests.collect()}
    manifest = spark.createDataFrame(
        [("e", "one/events.jsonl", known["one"]), ("e", "two/events.jsonl", "other"), ("e", "three/events.jsonl", "x")],
        "table_name string, file string, sha256 string",
    )
    got = {r.file: r.status for r in readers.manifest_check(manifest, digests, str(tmp_path)).collect()}
    assert got == {"one/events.jsonl": "ok", "two/events.jsonl": "hash_mismatch", "three/events.jsonl": "missing_file"}


def test_digits_in_text_are_no_epoch(spark):
    row = spark.range(1).select(
        instant(F.lit("20260808")).alias("text"),
        instant(F.lit("2026-08-08T08:00:00+08:00")).alias("iso"),
        variant_instant(F.parse_json(F.lit("1786147200"))).alias("number"),
        variant_instant(F.parse_json(F.lit("1786147200000"))).alias("millis"),
        variant_instant(F.parse_json(F.lit('"20260808"'))).alias("quoted"),
        variant_instant(F.parse_json(F.lit('"2026-08-08T08:00:00+08:00"'))).alias("quoted_iso"),
    ).first()
    assert row.text is None and row.quoted is None
    assert row.iso == row.number == row.millis == row.quoted_iso is not None


def test_texts_are_not_cut(spark):
    long = "word " * 5000
    nested = json.dumps({"k": "deep"})
    for _ in range(11):
        nested = json.dumps([nested])
    frame = content.open_texts(spark.createDataFrame([(long, nested)], "t string, j string"), "j", "inner")
    row = frame.select(
        compact_text(F.col("t")).alias("whole"),
        markdown_summary(F.col("t")).alias("summary"),
        compact_text(F.col("t"), 10).alias("short"),
        "inner",
    ).first()
    assert row.whole == row.summary == long.strip() and row.short == "word word…"
    assert "deep" in row.inner.split() and "[" not in row.inner


def test_texts_are_opened_however_often_they_are_quoted(spark):
    """Quotes and backslashes as escapes grow by five characters a level, so 30 levels are a short text."""

    def quoted(text: str, levels: int) -> str:
        for _ in range(levels):
            text = '"' + text.replace("\\", "\\u005c").replace('"', "\\u0022") + '"'
        return text

    rows = [(0, "Deep Concept"), (1, quoted("Deep Concept", 15)), (2, quoted("Deep Concept", 30)), (3, quoted("other", 30))]
    rows += [(4, None), (5, "  "), (6, '{"deep": ["con", {"cept": 1}]} x'), (7, '{"de\\"ep": [1, "con-cept"]}'), (8, "deep concept banned")]
    frame = content.semantic_gate(spark.createDataFrame(rows, "id int, t string"), "t", [["deep concept"]], ["banned"], "gate")
    assert len(rows[2][1]) < 12_000 and frame.columns == ["id", "t", "gate"]
    want = {0: "ok", 1: "ok", 2: "ok", 3: "mismatch", 4: "unverifiable", 5: "unverifiable", 6: "ok", 7: "ok", 8: "mismatch"}
    assert {r.id: r.gate for r in frame.collect()} == want
    opened = content.open_texts(spark.createDataFrame([(1, '["a", {"k": "[\\"b\\", \\"c\\"]"}, 3]'), (2, None)], "id int, t string"), "t")
    assert {r.id: r.opened_text for r in opened.collect()} == {1: "a k b c", 2: None}


def test_deep_documents_are_opened(spark):
    deep = {"secret_note": "plain"}
    for _ in range(150):
        deep = {"n": deep}
    frame = spark.createDataFrame([(1, json.dumps(deep))], "id long, j string").select("id", F.parse_json("j").alias("v"))
    assert "plain" in [r.text for r in scan.flatten_documents(frame, "id", "v").collect()]


def test_shared_names_match_every_company(spark):
    items = spark.createDataFrame([("i1", None, "Acme"), ("i2", "A", "Acme"), ("i3", None, "")], "id string, security_code string, security_name string")
    companies = spark.createDataFrame([("A", "Acme"), ("B", "Acme"), ("C", "")], "security_code string, security_name string")
    got = sorted(map(tuple, content.related(items, companies).select("security_code", "id").collect()))
    assert got == [("A", "i1"), ("A", "i2"), ("B", "i1"), ("B", "i2")]


def test_two_fetches_of_a_fact_give_the_newest(spark):
    facts = spark.createDataFrame(
        [("A", "2025-12-31", "revenue", 1.0, "present", "2026-01-01"), ("A", "2025-12-31", "revenue", 2.0, "present", "2026-02-01")],
        "security_code string, period_end string, canonical_field_name string, value double, value_status string, fetched_at string",
    )
    metrics = spark.createDataFrame(
        [("A", "2025-12-31", "npm", 0.1, "calculated", "2026-01-01"), ("A", "2025-12-31", "npm", 0.2, "calculated", "2026-02-01")],
        "security_code string, period_end string, metric_name string, value double, calculation_status string, fetched_at string",
    )
    reports = spark.createDataFrame(
        [("A", "2025-12-31", "annual", "FY", "2026-01-01", "2026-01-01"), ("A", "2025-12-31", "annual", "FY", "2026-01-05", "2026-02-01")],
        "security_code string, period_end string, report_type string, report_period_label string, filing_date string, fetched_at string",
    )
    rows = marts.period_mart(facts, metrics, reports).collect()
    assert [(r.facts, r.metrics, r.filing_date) for r in rows] == [({"revenue": 2.0}, {"npm": 0.2}, "2026-01-05")]


def test_two_raw_names_for_one_field(spark):
    cells = spark.createDataFrame(
        [("r", "close", "close", "unadjusted"), ("r", "close:raw", "close", "unadjusted"), ("r", "close:adj", "close", "forward_adjusted")],
        "row string, raw_field_name string, canonical_field_name string, adjustment_type string",
    ).selectExpr("*", "parse_json('\"1\"') AS cell", "'u' AS unit", "'high' AS confidence")
    got = cells.groupBy("row").agg(normalize.lineage_map(["close"]).alias("lineage")).first().lineage
    assert list(got) == ["close"] and got["close"].raw_field_name == "close"


def test_facts_at_other_days_come_back(spark):
    from tests.fixtures import fact

    facts = spark.createDataFrame([fact("A", "2025-11-30", "revenue", 1.0)])
    metrics, rejected = m.advanced_metrics(facts, "v")
    assert metrics.count() == 0 and rejected.count() == 1
