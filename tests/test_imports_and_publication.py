"""Reasons of imports, history of jobs, the content mart and its domains, bodies and row rules."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import content, coverage, jobs, quality
from tidemark.plans import marts

COLLECTION = (
    "collection_id string, query string, job_id string, request_version int, expected_period_end string, query_sha256 string, "
    "financial_periods array<string>, label_periods array<string>, filing_periods array<string>"
)
RESPONSE = "collection_id string, request_page int, request_limit int, code_count int, returned int, success boolean, status_code int"
PERIOD = "2025-12-31"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def assess(spark, change, plan=True):
    base = {
        "collection": ["c", "q", "j", 1, PERIOD, sha("q"), [PERIOD], [PERIOD], [PERIOD]],
        "responses": [("c", 1, 2, 3, 2, True, 0), ("c", 2, 2, 3, 1, True, None)],
        "rows": [{"股票代码": " a "}, {"股票代码": "b"}, {"股票代码": "c"}],
        "plan": ("j", 1, PERIOD, "q", 1),
    }
    change(base)
    rows = spark.createDataFrame([("c", json.dumps(r)) for r in base["rows"]], "collection_id string, j string").select("collection_id", F.parse_json("j").alias("row"))
    planned = spark.createDataFrame([base["plan"]], "job_id string, request_version int, period_end string, query string, minimum_expected_count int")
    found = jobs.assess_collections(
        spark.createDataFrame([tuple(base["collection"])], COLLECTION), planned if plan else None, spark.createDataFrame(base["responses"], RESPONSE), rows
    ).first()
    assert (found.status == "ready_to_normalize") == (not found.blocked_reasons)
    return set(found.blocked_reasons)


def put(name, at, value):
    def change(base):
        base[name][at] = value

    return change


@pytest.mark.parametrize(
    "change, reasons",
    [
        (lambda b: None, set()),
        (lambda b: b["collection"].__setitem__(slice(2, 6), [None] * 4), {"financial_job_contract_missing"}),
        (put("collection", 5, sha("other")), {"financial_plan_query_hash_mismatch"}),
        (put("collection", 1, "other"), {"financial_plan_query_mismatch"}),
        (put("collection", 2, "k"), {"financial_job_unknown"}),
        (put("collection", 3, 2), {"financial_request_version_mismatch"}),
        (put("collection", 6, ["2025-06-30"]), {"financial_period_mismatch"}),
        (put("collection", 7, []), {"financial_report_period_label_mismatch"}),
        (put("collection", 8, [PERIOD, "2024-12-31"]), {"financial_filing_date_period_mismatch"}),
        (put("rows", 0, [1, 2]), {"financial_row_invalid", "financial_unique_security_count_mismatch"}),
        (put("rows", 0, {"股票代码": 7}), {"financial_security_code_missing", "financial_unique_security_count_mismatch"}),
        (put("rows", 0, {"股票代码": " "}), {"financial_security_code_missing", "financial_unique_security_count_mismatch"}),
        (put("rows", 0, {"股票代码": "b"}), {"financial_duplicate_security_codes", "financial_unique_security_count_mismatch"}),
    ],
)
def test_each_reason_of_an_import(spark, change, reasons):
    assert assess(spark, change) == reasons


def test_an_import_without_a_plan(spark):
    assert assess(spark, lambda b: None, plan=False) == {"financial_plan_missing"}


def test_history_of_a_job(spark):
    snapshots = [("a", 1, "old", "f1"), ("a", 2, "old", "f2"), ("a", 1, "new", "f3"), ("b", 1, "old", "f4"), (None, None, "old", "f1"), (None, None, "old", "f1"), (None, None, "new", "f5")]
    history = [("a", [(1, "old"), (0, "old"), (1, "old")]), ("b", []), ("c", None), ("d", [(3, "old")])]
    frame = spark.createDataFrame(snapshots, "job_id string, request_version int, query string, fingerprint string")
    table = spark.createDataFrame(history, "job_id string, historical_queries array<struct<request_version:int,query:string>>")
    found = jobs.snapshot_summary(jobs.historical_snapshots(frame, table)).collect()
    assert {r.job_id: (r.snapshot_count, r.fingerprint_count) for r in found} == {"a": (3, 1), "d": (2, 1)}


def test_content_mart_with_reports_and_statuses(spark):
    item = "news_id string, event_id string, published_at string, title string, summary string, url string"
    news = spark.createDataFrame([("n1", None, "2026-01-02T00:00:00+08:00", "t", "s", "https://example.com/a"), ("n1", None, "2026-01-02T00:00:00+08:00", "t", "longer", "https://example.com/a"), ("n2", None, "2026-01-03", "t", "s", "http://localhost/")], item).drop("event_id")
    events = spark.createDataFrame([], item).drop("news_id")
    documents = spark.createDataFrame([("x/2026/02/03/a.md", "\n# Title\nfirst\n# second\nline"), ("x/b.md", "no title line")], "path string, text string")
    reports = content.document_rows(documents)
    sources = spark.createDataFrame([("news", "b1"), ("news", "b1"), ("events", "b2")], "domain string, source string")
    mart = marts.content_mart(news, events, reports, sources)
    got = {r.domain: (r.status, r.source_count, r.record_count, r.as_of_date) for r in mart["domains"].collect()}
    assert got == {"news": ("ready", 1, 1, "2026-01-02"), "events": ("empty", 1, 0, None), "reports": ("missing", 0, 2, "2026-02-03"), "content": ("ready", 2, 3, "2026-02-03")}
    assert mart["reports"].count() == 2 and mart["news_rejected"].count() == 1
    bare = {r.domain: r.status for r in marts.content_mart(news, events)["domains"].collect()}
    assert bare == {"news": "ready", "events": "missing", "content": "ready"}
    bodies = {r.id: r.body for r in content.document_bodies(documents).collect()}
    assert bodies == {"document-x/2026/02/03/a.md": "first\n# second\nline", "document-x/b.md": "no title line"}


def test_union_of_unmapped_fields(spark):
    parsed = spark.createDataFrame([("s", "a", "mapped"), ("s", "b", "unmapped"), ("s", "b", "unmapped"), ("t", "c", "unmapped")], "snapshot string, base_field_name string, mapping_status string")
    assert sorted(map(tuple, coverage.unmapped_fields(parsed, ["snapshot"]).collect())) == [("s", "b", 2), ("t", "c", 1)]


def test_row_rules_name_the_column(spark):
    rows = spark.createDataFrame([(1, " ", "2026-13-01", "-1", "2", "z"), (2, "x", "", "", "", ""), (3, None, "2026-01-01", "nan", "1", "a")], "k int, code string, day string, n string, r string, e string")
    rules = quality.contract_rules(["code"], ["day"], ["n"], ["r"], {"e": ["a"]})
    got = sorted(map(tuple, quality.violations(rows, ["k"], rules).collect()))
    assert got == [(1, "code:required"), (1, "day:no_iso_date"), (1, "e:not_listed"), (1, "n:negative"), (1, "r:no_ratio"), (3, "code:required"), (3, "n:negative")]
