"""Queries on larger and odd tables: keys beyond the small tables' range, and work that must not grow faster than its input."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import detect
from tidemark.operators import content
from tidemark.operators import metrics as m
from tidemark.operators import normalize as nz
from tidemark.plans import catalogue, derived
from tidemark.plans.catalogue_published import SEEDS
from tidemark.plans.registry import ORACLES, QUERIES

catalogue.load()


def same_as_sql(spark, folder, name):
    """The query's rows, which must be those of its SQL."""
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in sorted(folder.glob("*.parquet")):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}/*.parquet'")
    frame = QUERIES[name](spark, str(folder))
    got = sorted((tuple(r) for r in frame.collect()), key=repr)
    assert got == sorted(con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLES[name]})").fetchall(), key=repr)
    return got


@pytest.mark.parametrize("name", ["portfolio_valuation", "valuation_summary"])
def test_positions_with_keys_beyond_six_digits_and_the_first_exchange(spark, sf_small, tmp_path, name):
    part = spark.read.parquet(f"{sf_small}/part.parquet")
    far = [part.withColumn("p_partkey", F.col("p_partkey") + shift) for shift in (0, 99_990, 399_990)]
    far[0].unionByName(far[1]).unionByName(far[2]).write.parquet(str(tmp_path / "part.parquet"))
    spark.read.parquet(f"{sf_small}/lineitem.parquet").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = same_as_sql(spark, tmp_path, name)
    if name == "portfolio_valuation":
        codes = {r[1] for r in got}
        assert {"699998.SH", "700000.SZ", "700001.SH", "999999.SH", "1000000", "1000001.SH"} <= codes


def test_rows_of_fetches_give_the_metrics_of_long_rows(spark):
    """Newer fetches that lack a fact or miss its value, ties of a fetch, and a fetch without any fact."""
    fetch = "struct<statement_type: string, value: double, value_status: string>"
    fields = ["revenue", "net_income_parent", "net_cash_flow_operating"]
    held = lambda v: ("s" if v else "t", v, "present" if v is not None else "missing_in_source")
    rows = [
        ("A", "a1", "2025-12-31", "FY", "f1", "v1", 1, "r1", held(10.0), held(2.0), held(3.0)),
        ("A", "a2", "2025-12-31", "FY", "f2", "v2", 2, "r1", None, held(None), held(5.0)),
        ("A", "a3", "2025-12-31", "FY", "f3", "v3", 2, "r1", held(0.0), None, None),
        ("A", "a4", "2025-12-31", "FY", "f4", "v4", 9, "r9", None, None, None),
        ("B", "b1", "2025-12-31", "FY", "f1", "v1", 1, "r2", held(4.0), held(float("nan")), None),
        ("C", "c1", "2025-12-31", "FY", "f1", "v1", 1, "r2", None, None, None),
    ]
    names = "security_code string, security_name string, period_end string, report_type string, filing_date string, available_from string, fetched_at int, raw_record_id string"
    fetches = spark.createDataFrame(rows, ", ".join([names, *[f"{f} {fetch}" for f in fields]]))
    packed = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("canonical_field_name"), F.col(f).alias("fact"))) for f in fields]))
    long = fetches.select(*[n.split(" ")[0] for n in names.split(", ")], F.inline(packed)).select("*", "fact.*").drop("fact")
    got, want = (sorted(map(repr, m.ratio_metrics(f).collect())) for f in (fetches, long))
    assert got == want and len(got) == 10


def test_facts_of_parts_are_combined_one_row_for_each_fetch(spark, sf_small):
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    fetches = lines.select("l_partkey", F.year("l_shipdate"), "l_returnflag").distinct().count()
    assert derived.part_facts(lines).count() == fetches


def test_what_a_task_combines_depends_on_the_part_not_on_the_table(spark):
    """Parts of a bounded number of rows; cells are combined where their row is, without another shuffle by row."""
    rows = spark.range(10_000).withColumnRenamed("id", "row")
    dealt = nz.spread(rows, ["row"], part_rows=1_000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 10 and max(sizes) < 1_300
    assert nz.spread(rows.limit(0), ["row"]).count() == 0


def test_reports_with_identity_in_other_cells_and_rows_without_a_report(spark):
    variant = lambda t: F.try_parse_json(F.concat(F.lit('"'), F.col(t), F.lit('"')))
    cells = [
        (1, "security_code", "identity", None, None, "000001.SZ"), (1, "security_name", "identity", None, None, "one"),
        (1, "revenue", "financial", "2024-12-31", "FY", "5"), (1, "revenue", "financial", "2023-12-31", "FY", "x"),
        (1, "filing_date", "financial_metadata", "2024-12-31", "2024FY", "20250430"), (1, "report_period_label", "financial_metadata", "2024-12-31", "2024FY", "2024年年报"),
        (2, "security_code", "identity", None, None, "000002.SZ"),  # a row without any report
        (3, "inventory", "financial", "2024-06-30", "H1", ""),  # a report without an identity, not in the source
    ]
    names = ["row", "canonical_field_name", "category", "period_end", "report_type", "text"]
    frame = spark.createDataFrame(cells, "row int, canonical_field_name string, category string, period_end string, report_type string, text string")
    described = frame.select(
        *[n for n in names if n != "text"], variant("text").alias("cell"), F.col("canonical_field_name").alias("raw_field_name"),
        *[F.lit("u").alias(c) for c in ("statement_type", "value_nature", "unit", "confidence", "query_group", "raw_record_id")],
        F.lit("2030-01-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )
    found = nz.financial_tables(described, ["row"])
    held = {k: sorted((r.row, r.security_code or "-", r.period_end) for r in f.collect()) for k, f in found.items()}
    assert held["missing"] == [(3, "-", "2024-06-30")] and held["rejected"] == [(1, "000001.SZ", "2023-12-31")]
    assert held["reports"] == held["facts"] == [(1, "000001.SZ", "2024-12-31")]
    plan = found["facts"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan  # the tables are read, not derived again


def test_gates_of_detectors_hold_for_every_finding(spark):
    """Seeds, odd spellings that the patterns' case folding takes, paths and URLs beside each other."""
    odd = [
        "BEARER\tabcdefghijklmnop0123", "ba\u017fic dXNlcjpwYXNzd29yZA==", "coo\u212aie: a=b", "author\u0131zation: x", "C:\\x", "c:/x", "\\\\host\\share",
        "file:///x", "see https://a.b/home/x, /home/y", "https://a.b/home/x", "ftp://u:p@h/data/raw/x", "inbox\\x", "", "plain words: a = b / c",
    ]
    texts = [t for _, t in SEEDS] + odd
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    text = F.col("t")
    marks = frame.select("i", *[F.struct(d(text).alias("found"), detect.GATES[n](text).alias("gate")).alias(n) for n, d in detect.DETECTORS.items()])
    rows = marks.orderBy("i").collect()
    assert set(detect.GATES) == set(detect.DETECTORS) and all(r[n].gate or not r[n].found for r in rows for n in detect.GATES)
    got = [sorted(n for n in detect.GATES if r[n].found) for r in rows]
    assert got[: len(SEEDS)] == [[n] if n else [] for n, _ in SEEDS]
    assert got[len(SEEDS) :] == [
        ["bearer_value"], ["basic_credential"], ["cookie_header"], ["authorization_header"], ["local_path"], ["local_path"], ["local_path"],
        ["local_path"], ["local_path"], [], ["private_path", "url_userinfo"], ["private_path"], [], [],
    ]


def test_opened_texts_are_read_by_a_stored_mark_not_parsed_again(spark):
    import json

    deep = "end"
    for _ in range(9):
        deep = json.dumps([deep])
    frame = content.open_texts(spark.createDataFrame([(1, deep), (2, "plain"), (3, None), (4, '["a", "b"]')], "id int, t string"), "t")
    assert sorted((r.id, r.opened_text) for r in frame.collect()) == [(1, "end"), (2, "plain"), (3, None), (4, "a b")]
    assert "try_parse_json" not in frame._jdf.queryExecution().optimizedPlan().toString()
