"""Status of paged jobs."""

from __future__ import annotations

from tidemark.operators import jobs as j

SNAPSHOT = "job_id string, record_id string, page int, page_limit int, total int, returned int, errors array<string>"


def status(spark, snapshots, members, unbound=None):
    jobs = spark.createDataFrame([("a", 1), ("b", 1)], "job_id string, minimum_expected_count int")
    rows = j.job_status(
        jobs,
        spark.createDataFrame(snapshots, SNAPSHOT),
        spark.createDataFrame(members, "job_id string, code string"),
        None if unbound is None else spark.createDataFrame(unbound, "job_id string, fingerprint string"),
    )
    return {r.job_id: (r.status, list(r.errors), r.next_page) for r in rows.collect()}


def test_complete_and_partial(spark):
    got = status(
        spark,
        [("a", "r1", 1, 2, 3, 2, []), ("a", "r2", 2, 2, 3, 1, []), ("b", "r3", 1, 2, 5, 2, [])],
        [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", "y")],
    )
    assert got["a"] == ("complete", [], None) and got["b"] == ("partial", [], 2)


def test_repeated_page_and_drift(spark):
    got = status(
        spark,
        [("a", "r1", 1, 2, 4, 2, []), ("a", "r2", 1, 2, 4, 2, []), ("b", "r3", 1, 2, 2, 2, ["collection_job_query_drift"])],
        [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")],
    )
    assert got["a"][0] == "partial" and "duplicate_pages" in got["a"][1]
    assert got["b"][0] == "quarantined"


def test_unbound_snapshot_quarantines_a_job_without_its_own(spark):
    snapshots = spark.createDataFrame(
        [(None, "q2", "f1"), (None, "alias", "f2"), (None, "q1", "f3"), ("b", "q2", "f4")],
        "job_id string, query string, fingerprint string",
    )
    jobs = spark.createDataFrame(
        [("a", 1, "q1", None), ("b", 2, "q2", ["alias"])],
        "job_id string, request_version int, query string, query_aliases array<string>",
    )
    loose = sorted(map(tuple, j.unbound_snapshots(snapshots, jobs).collect()))
    assert loose == [("b", "f1"), ("b", "f2")]
    got = status(spark, [], [], loose)
    assert got["a"] == ("not_started", [], 1)
    assert got["b"] == ("quarantined", ["collection_job_identity_missing"], None)


def test_negative_total_is_one_fault(spark):
    one = "collection_id string, job_known boolean, version_matches boolean, period_matches boolean, query_matches boolean, minimum_expected_count int, contract_errors array<string>"
    collections = spark.createDataFrame([("c", True, True, True, True, 1, [])], one)
    responses = spark.createDataFrame(
        [("c", 1, 2, 2, 2, True, 200), ("c", 2, 2, -1, 0, True, 200)],
        "collection_id string, request_page int, request_limit int, code_count int, returned int, success boolean, status_code int",
    )
    members = spark.createDataFrame([("c", "x"), ("c", "y")], "collection_id string, code string")
    reasons = j.import_assessment(collections, responses, members).first().blocked_reasons
    assert "financial_code_count_invalid" in reasons and "financial_code_count_inconsistent" not in reasons
