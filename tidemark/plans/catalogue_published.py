"""Queries over publication, feeds, row rules, coverage of searches, runs, batches and seeded detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import names as nm
from tidemark.operators import content as ct
from tidemark.operators import coverage as cv
from tidemark.operators import jobs as jb
from tidemark.operators import metrics as mx
from tidemark.operators import quality as qa
from tidemark.operators import scan
from tidemark.plans import derived, marts
from tidemark.plans.registry import register, table


# --- content ------------------------------------------------------------------------
def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Announcement items of the events: repeats of a title, missing parts, one or several securities."""
    k = F.col("event_id")
    security = F.struct(F.lpad((F.col("user_id") % 1000).cast("string"), 6, "0").alias("code"), F.concat(F.lit("n"), F.col("user_id").cast("string")).alias("name"))
    return table(spark, folder, "events").select(
        F.when(k % 17 != 0, F.concat(F.lit("title "), F.col("event_type"), F.lit(" "), (k % 400).cast("string"))).alias("title"),
        F.concat(F.lit("summary "), k.cast("string")).alias("summary"),
        F.when(k % 19 == 0, F.lit(" ")).otherwise(F.concat(F.lit("https://example.com/"), (k % 400).cast("string"))).alias("url"),
        F.when(k % 23 != 0, F.date_format("ts", "yyyy-MM-dd'T'00:00:00+08:00")).alias("publish_time"),
        F.struct(F.lit("").alias("real_publish_source"), F.col("event_type").alias("publish_source")).alias("extra"),
        F.when(k % 3 == 0, F.array(security)).when(k % 3 == 1, F.array(security, security)).otherwise(F.slice(F.array(security), 1, 0)).alias("stock_infos"),
        F.lit("q").alias("query"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"), F.format_string("%012d", "event_id").alias("raw_record_id"), k.alias("position"),
    )


_SQL_ITEMS = """i AS (SELECT event_id AS k, CASE WHEN event_id % 17 <> 0 THEN 'title ' || event_type || ' ' || event_id % 400 END AS title, CASE WHEN event_id % 19 = 0 THEN ' ' ELSE 'https://example.com/' || event_id % 400 END AS url,
  CASE WHEN event_id % 23 <> 0 THEN strftime(ts, '%Y-%m-%dT00:00:00+08:00') END AS published, event_type AS publisher, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS fetched, lpad((user_id % 1000)::VARCHAR, 6, '0') AS code FROM events),
a AS (SELECT *, left(sha256('news' || chr(0) || url || chr(0) || published || chr(0) || title), 24) AS id FROM i WHERE title IS NOT NULL AND url <> ' ' AND published IS NOT NULL),
c AS (SELECT id AS news_id, title, published AS published_at, publisher, CASE WHEN k % 3 = 0 THEN code END AS source_security_code, k AS position, fetched FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY fetched, lpad(k::VARCHAR, 12, '0')) = 1)"""


@register("content_rows", f"WITH {_SQL_ITEMS} SELECT news_id, title, published_at, publisher, source_security_code, position FROM c")
def content_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The content table of all items: ids, instants, publishers and single securities; the first of an id stays."""
    rows, _ = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    return rows.select("news_id", "title", "published_at", "publisher", "source_security_code", "position")


@register(
    "content_rejects",
    f"""WITH {_SQL_ITEMS} SELECT CASE WHEN title IS NULL THEN 'title:required' WHEN url = ' ' THEN 'url:required' ELSE 'publish_time:invalid' END AS reject_reason, count(*) AS n
FROM i WHERE title IS NULL OR url = ' ' OR published IS NULL GROUP BY 1""",
)
def content_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@register(
    "scope_filter",
    f"""WITH {_SQL_ITEMS} SELECT news_id, source_security_code FROM c WHERE source_security_code IN (SELECT DISTINCT lpad((c_custkey % 1000)::VARCHAR, 6, '0') FROM customer WHERE c_mktsegment = 'FURNITURE')""",
)
def scope_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Content about the securities of a target list."""
    rows, _ = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    targets = table(spark, folder, "customer").where("c_mktsegment = 'FURNITURE'").select(F.concat(F.lpad((F.col("c_custkey") % 1000).cast("string"), 6, "0"), F.lit(".SZ")).alias("security_code"))
    return ct.scope_filter(rows, targets).select("news_id", "source_security_code")


@register(
    "report_span",
    f"""WITH {_SQL_ITEMS} SELECT published_at[1:10] AS report_date, count(*) AS record_count, min(published_at) AS published_at_min, max(published_at) AS published_at_max, max(published_at) AS available_from_max FROM c GROUP BY 1""",
)
def report_span(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    return ct.report_span(rows, F.left("published_at", F.lit(10)))


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown reports: the documents under paths with a date."""
    path = F.concat(F.lit("reports/2026/0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("/11/"), F.col("doc_id").cast("string"), F.lit(".md"))
    heading = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# Report "), F.col("doc_id").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    return table(spark, folder, "documents").where("text IS NOT NULL").select(path.alias("path"), F.concat(heading, "text").alias("text"))


@register(
    "report_bodies",
    r"""SELECT 'document-reports/2026/0' || (doc_id % 9 + 1) || '/11/' || doc_id || '.md' AS id, CASE WHEN doc_id % 2 = 0 THEN 'Report ' || doc_id ELSE doc_id::VARCHAR END AS title,
  '2026-0' || (doc_id % 9 + 1) || '-11' AS date, sha256(trim(text, ' ')) AS body_sha256 FROM documents WHERE text IS NOT NULL""",
)
def report_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Title, date and digest of the whole body of every report."""
    reports = _reports(spark, folder)
    rows = ct.document_rows(reports).select("id", "title", "date")
    return rows.join(ct.document_bodies(reports), "id").select("id", "title", "date", F.sha2("body", 256).alias("body_sha256"))


@register(
    "published_marts",
    f"""WITH {_SQL_ITEMS}, m AS (SELECT title, min(published_at) AS lo, max(published_at) AS hi, count(DISTINCT (published_at, publisher)) AS n FROM c GROUP BY 1),
r AS (SELECT 'news' AS domain, count(*) FILTER (WHERE n = 1) AS record_count, max(lo[1:10]) FILTER (WHERE n = 1) AS as_of_date FROM m
  UNION ALL SELECT 'events', count(*), max(published_at[1:10]) FROM c UNION ALL SELECT 'reports', count(*), max('2026-0' || (doc_id % 9 + 1) || '-11') FROM documents WHERE text IS NOT NULL),
s AS (SELECT domain, CASE domain WHEN 'news' THEN 5 WHEN 'reports' THEN 1 ELSE 0 END::BIGINT AS source_count, record_count, as_of_date FROM r)
SELECT domain, source_count, record_count, as_of_date, CASE WHEN source_count = 0 THEN 'missing' WHEN record_count = 0 THEN 'empty' ELSE 'ready' END AS status FROM s
UNION ALL SELECT 'content', sum(source_count)::BIGINT, sum(record_count)::BIGINT, max(as_of_date), 'ready' FROM s""",
)
def published_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Domains of the content mart: news merged by title, events, reports; the events' bundles were not read."""
    rows, _ = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    news = rows.select(F.col("title").alias("news_id"), "title", "published_at", "publisher", F.lit("s").alias("summary"))
    events = rows.select(F.col("news_id").alias("event_id"), "title", "published_at")
    sources = table(spark, folder, "events").select(F.lit("news").alias("domain"), F.col("event_type").alias("source"))
    sources = sources.unionByName(spark.range(1).select(F.lit("reports").alias("domain"), F.lit("folder").alias("source")))
    return marts.content_mart(news, events, ct.document_rows(_reports(spark, folder)), sources)["domains"]


@register(
    "market_shards",
    """SELECT left(sha256(lpad(c_custkey::VARCHAR, 6, '0') || '.SZ'), 1) AS shard, count(*) AS record_count FROM customer GROUP BY 1""",
)
def market_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Published queue rows of each shard, under their published names."""
    screen = table(spark, folder, "customer").select(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit(".SZ")).alias("security_code"), F.col("c_name").alias("security_name"), F.col("c_acctbal").alias("score"), F.lit("x").alias("unpublished")
    )
    return marts.shard_counts(marts.market_mart(screen))


# --- row rules ----------------------------------------------------------------------
@register(
    "portfolio_rules",
    """WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE 'x' END AS code, CASE o_orderkey % 6 WHEN 0 THEN '2026-02-30' WHEN 1 THEN '' ELSE '2026-02-03' END AS day,
  CASE o_orderkey % 7 WHEN 0 THEN '-1' WHEN 1 THEN 'abc' WHEN 2 THEN '' ELSE '5.5' END AS quantity, CASE o_orderkey % 8 WHEN 0 THEN '1.01' WHEN 1 THEN '0' ELSE '0.5' END AS weight, o_orderpriority AS kind FROM orders)
SELECT k, 'code:required' AS rule_id FROM r WHERE k % 10 = 0 UNION ALL SELECT k, 'day:no_iso_date' FROM r WHERE k % 6 = 0 UNION ALL SELECT k, 'quantity:negative' FROM r WHERE k % 7 < 2
UNION ALL SELECT k, 'weight:no_ratio' FROM r WHERE k % 8 = 0 UNION ALL SELECT k, 'kind:not_listed' FROM r WHERE kind NOT IN ('1-URGENT', '2-HIGH')""",
)
def portfolio_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of a text table, one row for each key and rule."""
    k = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        k.alias("k"), F.when(k % 10 == 0, F.lit(" ")).otherwise(F.lit("x")).alias("code"), F.when(k % 6 == 0, F.lit("2026-02-30")).when(k % 6 == 1, F.lit("")).otherwise(F.lit("2026-02-03")).alias("day"),
        F.when(k % 7 == 0, F.lit("-1")).when(k % 7 == 1, F.lit("abc")).when(k % 7 == 2, F.lit("")).otherwise(F.lit("5.5")).alias("quantity"),
        F.when(k % 8 == 0, F.lit("1.01")).when(k % 8 == 1, F.lit("0")).otherwise(F.lit("0.5")).alias("weight"), F.col("o_orderpriority").alias("kind"),
    )
    rules = qa.contract_rules(["code"], ["day"], ["quantity"], ["weight"], {"kind": ["1-URGENT", "2-HIGH"]})
    return qa.violations(rows, ["k"], rules)


@register(
    "price_bar_rules",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_extendedprice - 1000 AS o, l_extendedprice + 5 * (l_linenumber - 3) AS h, l_extendedprice - 5 AS l, l_extendedprice AS c, l_quantity - 2 AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, 'non_positive_price' AS rule_id FROM b WHERE least(o, h, l, c) <= 0 UNION ALL SELECT l_orderkey, l_linenumber, 'high_below_low' FROM b WHERE h < l
UNION ALL SELECT l_orderkey, l_linenumber, 'open_outside_range' FROM b WHERE h >= l AND NOT o BETWEEN l AND h UNION ALL SELECT l_orderkey, l_linenumber, 'close_outside_range' FROM b WHERE h >= l AND NOT c BETWEEN l AND h
UNION ALL SELECT l_orderkey, l_linenumber, 'negative_volume' FROM b WHERE v < 0""",
)
def price_bar_rules(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    bars = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (price - 1000).alias("open"), (price + 5 * (F.col("l_linenumber") - 3)).alias("high"), (price - 5).alias("low"), price.alias("close"),
        (F.col("l_quantity") - 2).alias("volume"), F.lit(None).cast("double").alias("turnover"),
    )
    return qa.violations(bars, ["l_orderkey", "l_linenumber"], qa.price_bar_rules())


@register(
    "document_rules",
    """WITH d AS (SELECT doc_id AS k FROM documents)
SELECT k, 'fact_id:repeated' AS rule_id FROM d WHERE k % 5 = 0 UNION ALL SELECT k, 'supporting_fact_ids:unknown' FROM d WHERE k % 7 = 0 UNION ALL SELECT k, 'confidence:not_listed' FROM d WHERE k % 3 = 0
UNION ALL SELECT k, 'ready:red_team' FROM d WHERE k % 2 = 0 AND k % 11 = 0 UNION ALL SELECT k, 'valuation:cases' FROM d WHERE k % 13 = 0 UNION ALL SELECT k, 'proposed_weight:no_ratio' FROM d WHERE k % 4 = 0""",
)
def document_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of nested research documents."""
    k = F.col("doc_id")
    none = F.slice(F.array(F.lit("")), 1, 0)
    fact = lambda i: F.struct(i.alias("fact_id"), F.lit("c").alias("claim"), F.lit("u").alias("source_url"), F.lit("2026-01-01").alias("as_of_date"))
    case = F.struct(F.lit("m").alias("method"), F.lit(1.0).alias("estimated_value"))
    cases = [F.struct(F.lit(c).alias("key"), case.alias("value")) for c in ("bull", "base", "bear")]
    rows = table(spark, folder, "documents").select(
        k.alias("k"), F.when(k % 2 == 0, F.lit("decision_ready")).otherwise(F.lit(fixed.RESEARCH_STATUSES[0])).alias("status"), F.lit("P1").alias("priority"),
        F.array(fact(F.lit("f1")), fact(F.when(k % 5 == 0, F.lit("f1")).otherwise(F.lit("f2")))).alias("facts"),
        F.array(F.struct(F.when(k % 3 == 0, F.lit("sure")).otherwise(F.lit("high")).alias("confidence"), F.array(F.when(k % 7 == 0, F.lit("f9")).otherwise(F.lit("f1"))).alias("supporting_fact_ids"))).alias("inferences"),
        F.map_from_entries(F.slice(F.array(*cases), F.lit(1), F.when(k % 13 == 0, F.lit(2)).otherwise(F.lit(3)))).alias("valuation"), F.array(F.lit("b")).alias("thesis_breakers"),
        F.when(k % 11 == 0, none).otherwise(F.array(F.lit("r"))).alias("red_team"), F.when(k % 4 == 0, F.lit(1.5)).alias("proposed_weight"),
    )
    return qa.violations(rows, ["k"], qa.research_rules())


@register(
    "log_reconciliation",
    """WITH r AS (SELECT 'p' || o_orderkey AS path, o_custkey::VARCHAR AS id, o_orderkey AS k FROM orders), l AS (SELECT path, CASE WHEN k % 5 = 0 THEN 'other' ELSE id END AS id FROM r WHERE k % 3 <> 0
  UNION ALL SELECT path, id FROM r WHERE k % 7 = 0 UNION ALL SELECT 'x' || c_custkey, 'y' FROM customer),
g AS (SELECT path, count(*) AS n, min(id) AS lo FROM l GROUP BY 1)
SELECT path, CASE WHEN r.path IS NULL THEN 'dangling_log_entry' WHEN n IS NULL THEN 'missing_log_entry' WHEN n > 1 THEN 'duplicate_log_entry' WHEN lo <> id THEN 'record_id_mismatch' ELSE 'ok' END AS status FROM r FULL JOIN g USING (path)""",
)
def log_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots against a log that lacks some, repeats some, and names others."""
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    raw = orders.select(F.concat(F.lit("p"), k.cast("string")).alias("path"), F.col("o_custkey").cast("string").alias("record_id"), "o_orderkey")
    times = F.when(k % 3 != 0, 1).otherwise(0) + F.when(k % 7 == 0, 1).otherwise(0)
    entries = raw.withColumn("n", F.explode(F.sequence(F.lit(0), times))).where("n > 0")
    first = (F.col("n") == 1) & (k % 3 != 0)
    log = entries.select("path", F.when(first & (k % 5 == 0), F.lit("other")).otherwise(F.col("record_id")).alias("record_id"))
    loose = table(spark, folder, "customer").select(F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("path"), F.lit("y").alias("record_id"))
    return qa.log_reconciliation(raw.drop("o_orderkey"), log.unionByName(loose))


# --- searches, runs and batches -----------------------------------------------------
@register(
    "coverage_kpis",
    """WITH i AS (SELECT o_custkey % 40 AS t, o_orderkey AS k, o_orderpriority AS publisher, 'h' || o_orderkey % 6 || '.com' AS host, o_orderdate::DATE::VARCHAR AS d, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 500 END AS code FROM orders),
w AS (SELECT t AS wt, range AS code FROM (SELECT DISTINCT t FROM i), range(500) WHERE range % 10 = t % 10),
m AS (SELECT i.*, EXISTS (SELECT 1 FROM w WHERE wt = t AND w.code = i.code) AS hit FROM i),
g AS (SELECT t, count(*) AS n, count(DISTINCT publisher) AS p, count(DISTINCT host) AS h, min(d) AS lo, max(d) AS hi, count(*) FILTER (WHERE hit) AS a, count(*) FILTER (WHERE NOT hit AND code IS NOT NULL) AS b, count(*) FILTER (WHERE code IS NULL) AS c FROM m GROUP BY 1)
SELECT t::VARCHAR AS task_id, n AS returned_count, 400 > n AS truncated, n >= 300 AS requested_size_honored, p AS publisher_count, h AS domain_count, lo AS published_at_min, hi AS published_at_max,
  CASE WHEN t % 2 = 0 THEN a ELSE 0 END AS matched_items, CASE WHEN t % 2 = 0 THEN b ELSE 0 END AS off_scope_items, CASE WHEN t % 2 = 0 THEN c ELSE 0 END AS unidentified_items FROM g""",
)
def coverage_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage of search results: orders as results, customers as tasks."""
    k, t = F.col("o_orderkey"), (F.col("o_custkey") % 40).cast("string").alias("task_id")
    orders = table(spark, folder, "orders")
    code = F.concat(F.lpad((k % 500).cast("string"), 6, "0"), F.lit(".SZ"))
    items = orders.select(
        t, k.cast("string").alias("item_id"), F.col("o_orderpriority").alias("publisher"), F.concat(F.lit("https://H"), (k % 6).cast("string"), F.lit(".com/x")).alias("url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_at"),
        F.when(k % 4 != 0, F.array(code)).otherwise(F.slice(F.array(code), 1, 0)).alias("codes"),
    )
    tasks = orders.select(t).distinct().select(
        "task_id", F.lit(300).alias("requested_size"), F.lit(400).alias("reported_total"), F.when(F.col("task_id").cast("int") % 2 == 0, F.lit("p0_securities")).otherwise(F.lit("market")).alias("scope_type")
    )
    targets = tasks.select("task_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: i * 10 + F.col("task_id").cast("int") % 10)).alias("n"))
    targets = targets.select("task_id", F.lpad(F.col("n").cast("string"), 6, "0").alias("security_code"))
    return cv.search_coverage(items, tasks, targets).drop("scope_type", "requested_size", "reported_total")


@register(
    "run_status",
    """WITH r AS (SELECT o_custkey AS run, count(*) AS steps, bool_or(o_orderstatus = 'F') AS failed FROM orders GROUP BY 1)
SELECT run::VARCHAR AS run_id, CASE WHEN run % 4 = 0 OR failed THEN 'failed' WHEN run % 3 <> 0 THEN 'ready' ELSE 'partial' END AS publication_status, steps AS step_count FROM r""",
)
def run_status(spark: SparkSession, folder: str) -> DataFrame:
    """Publication status of runs: orders are the steps of their customer's run."""
    orders = table(spark, folder, "orders")
    run = F.col("o_custkey").cast("string").alias("run_id")
    steps = orders.select(run, F.when(F.col("o_orderstatus") == "F", F.lit("failed")).otherwise(F.lit("succeeded")).alias("status"))
    key = F.col("run_id").cast("long")
    runs = orders.select(run).distinct().select(
        "run_id", F.when(key % 4 == 0, F.lit("failed")).otherwise(F.lit("succeeded")).alias("status"), F.lit("up_to_date").alias("readiness_status"), F.lit("up_to_date").alias("research_status"),
        F.when(key % 3 == 0, F.lit(2)).otherwise(F.lit(0)).alias("incomplete_job_count"),
    )
    return cv.run_status(steps, runs).select("run_id", "publication_status", "step_count")


@register(
    "target_batches",
    """WITH p AS (SELECT lpad(c_custkey::VARCHAR, 6, '0') AS code, c_name, row_number() OVER (ORDER BY lpad(c_custkey::VARCHAR, 6, '0')) - 1 AS pos FROM customer)
SELECT pos // 25 + 1 AS batch_number, count(*) AS target_count, string_agg(code || ' ' || c_name, '、' ORDER BY pos) AS target_text FROM p GROUP BY 1""",
)
def target_batches(spark: SparkSession, folder: str) -> DataFrame:
    targets = table(spark, folder, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("security_code"), F.col("c_name").alias("security_name"))
    return jb.target_batches(targets)


# --- detectors ----------------------------------------------------------------------
#: A text for each detector; the first detector is the one it was made for.
SEEDS = [
    ("bearer_value", "sent bearer abcdefghijklmnop0123"),
    ("url_query_credential", "https://example.com/x?api_key=abc"),
    ("url_userinfo", "https://user:pw@example.com/x"),
    ("basic_credential", "sent basic dXNlcjpwYXNzd29yZA=="),
    ("authorization_header", "Authorization: token"),
    ("cookie_header", "Cookie: session=abc"),
    ("local_path", "kept in /home/someone/x"),
    ("private_path", "kept in data/raw/x"),
    (None, "https://example.com/home/x?page=2"),
    (None, "the bearer of basic news, a cookie, data and home"),
]


@register(
    "seeded_scan",
    "WITH s(i, category) AS (VALUES " + ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(SEEDS) if name) + f") SELECT doc_id, category FROM documents JOIN s ON doc_id % {len(SEEDS)} = i WHERE text IS NOT NULL",
)
def seeded_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with a text for each detector, or a harmless one, at their end."""
    seed = F.element_at(F.array(*[F.lit(text) for _, text in SEEDS]), (F.col("doc_id") % len(SEEDS)).cast("int") + 1)
    docs = table(spark, folder, "documents").select("doc_id", F.concat("text", F.lit("\n"), seed).alias("text"))
    return scan.scan_text(docs, ["doc_id"], "text")


# --- metrics ------------------------------------------------------------------------
def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return mx.ratio_metrics(derived.part_facts(table(spark, folder, "lineitem")))


_SQL_INPUTS = f"""WITH {derived.SQL_FACTS},
defs(metric_name, role, field) AS (VALUES ('net_profit_margin', 'numerator', 'net_income_parent'), ('net_profit_margin', 'denominator', 'revenue'),
  ('operating_profit_margin', 'numerator', 'operating_profit'), ('operating_profit_margin', 'denominator', 'revenue'),
  ('liability_to_assets', 'numerator', 'total_liabilities'), ('liability_to_assets', 'denominator', 'total_assets'),
  ('operating_cash_to_net_income', 'numerator', 'net_cash_flow_operating'), ('operating_cash_to_net_income', 'denominator', 'net_income_parent'),
  ('operating_cash_flow_margin', 'numerator', 'net_cash_flow_operating'), ('operating_cash_flow_margin', 'denominator', 'revenue')),
i AS (SELECT code, period_end, rec, metric_name, role, field, CASE field WHEN 'net_income_parent' THEN net_income WHEN 'revenue' THEN revenue WHEN 'net_cash_flow_operating' THEN cash END AS value,
  CASE WHEN field IN ('operating_profit', 'total_liabilities', 'total_assets') THEN 'fact_not_available' WHEN field = 'net_cash_flow_operating' AND cash IS NULL THEN 'missing_in_source' ELSE 'present' END AS value_status FROM facts, defs)"""


@register(
    "metric_lineage",
    _SQL_INPUTS
    + """ SELECT metric_name, role, field AS canonical_field_name, value_status, count(*) AS records, coalesce(sum(value::DECIMAL(38,0)), 0)::DOUBLE AS total,
  count(*) FILTER (WHERE value_status <> 'fact_not_available' AND rec = 'R') AS from_returns FROM i GROUP BY 1, 2, 3, 4""",
)
def metric_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """The inputs that metrics name, counted and summed by role, field and status."""
    inputs = _metrics(spark, folder).select("metric_name", F.inline("input_facts"))
    return inputs.groupBy("metric_name", "role", "canonical_field_name", "value_status").agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.col("value").cast("decimal(28,0)")), F.lit(0)).cast("double").alias("total"),
        F.count_if(F.col("raw_record_id") == "R").alias("from_returns"),
    )


@register(
    "metric_status",
    _SQL_INPUTS
    + """, p AS (SELECT code, period_end, metric_name, max(value) FILTER (WHERE role = 'numerator') AS n, max(value) FILTER (WHERE role = 'denominator') AS d FROM i GROUP BY 1, 2, 3)
SELECT metric_name, CASE WHEN n IS NULL OR d IS NULL THEN 'missing_inputs' WHEN d = 0 THEN 'zero_denominator' ELSE 'calculated' END AS calculation_status, count(*) AS record_count FROM p GROUP BY 1, 2""",
)
def metric_status(spark: SparkSession, folder: str) -> DataFrame:
    return mx.status_histogram(_metrics(spark, folder))


# --- bundles, families, feeds -------------------------------------------------------
@register(
    "period_gaps",
    """WITH c AS (SELECT date_trunc('month', o_orderdate)::DATE AS bundle, year(o_orderdate)::INTEGER AS period, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT period, max(n) AS n FROM c GROUP BY 1), limits AS (SELECT max(n) AS top FROM c)
SELECT r.period FROM (SELECT range::INTEGER AS period FROM range(1990, 2006)) r ANTI JOIN (SELECT period FROM b, limits WHERE n >= top - 1) g USING (period)""",
)
def period_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Required years whose best monthly bundle has fewer customers than the best of all, less one."""
    orders = table(spark, folder, "orders")
    counts = orders.groupBy(F.trunc("o_orderdate", "month").alias("bundle"), F.year("o_orderdate").alias("period")).agg(F.countDistinct("o_custkey").alias("n"))
    best = cv.best_bundle(counts, ["period"], "bundle", "n")
    most = best.agg(F.max("n")).first()[0] or 0
    required = spark.range(1990, 2006).select(F.col("id").cast("int").alias("period"))
    return cv.period_gaps(best, required, "period", "n", most - 1)


@register(
    "index_families",
    """WITH f AS (SELECT CASE p_size % 5 WHEN 0 THEN 'nasdaq_100' WHEN 1 THEN 'sp_500' WHEN 2 THEN 'nasdaq_100' END AS family FROM part)
SELECT n AS family, count(f.family) AS fund_count FROM (VALUES ('nasdaq_100'), ('sp_500'), ('none_such')) v(n) LEFT JOIN f ON f.family = n GROUP BY 1""",
)
def index_families(spark: SparkSession, folder: str) -> DataFrame:
    """Funds of each index family, with a row for families that have none; of two families in a name the first counts."""
    size = F.col("p_size") % 5
    tracked = F.when(size == 0, F.lit("the Nasdaq-100 index")).when(size == 1, F.lit("s & p 500")).when(size == 2, F.lit("标普500 和 纳指100")).when(size == 3, F.lit("  "))
    families = table(spark, folder, "part").select(nm.index_family(tracked).alias("family"))
    counted = families.where(F.col("family").isNotNull()).groupBy("family").agg(F.count(F.lit(1)).alias("fund_count"))
    return cv.filled_counts(counted, ["nasdaq_100", "sp_500", "none_such"], "family", "fund_count")


@register(
    "latest_run",
    """WITH r AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN ts END AS finished, CASE WHEN event_id % 3 < 2 THEN ts - INTERVAL 1 HOUR END AS started, ts::DATE AS day FROM events)
SELECT user_id, event_id FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY coalesce(finished, started, day::TIMESTAMP) DESC, event_id::VARCHAR DESC) = 1""",
)
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    """The newest run of each user by finish, else start, else the day of its path."""
    k = F.col("event_id")
    runs = table(spark, folder, "events").select(
        "user_id", k.alias("event_id"), k.cast("string").alias("run_id"), F.when(k % 3 == 0, F.col("ts").cast("timestamp")).alias("finished_at"),
        F.when(k % 3 < 2, F.col("ts").cast("timestamp") - F.expr("INTERVAL 1 HOUR")).alias("started_at"), F.to_date("ts").alias("path_date"), F.lit("p").alias("path"),
    )
    return cv.latest_run(runs, ["user_id"]).select("user_id", "event_id")


@register(
    "new_snapshots",
    """SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderstatus = 'F' AND p.o_custkey = o.o_custkey
  AND (CASE WHEN p.o_orderkey % 4 > 0 THEN p.o_orderpriority END) IS NOT DISTINCT FROM (CASE WHEN o.o_orderkey % 4 > 0 THEN o.o_orderpriority END))""",
)
def new_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that no finished order equals in customer and priority, where null equals null."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("priority"))
    return jb.new_snapshots(rows, rows.where("o_orderstatus = 'F'"), ["o_custkey", "priority"]).select("o_orderkey")


@register(
    "content_feed",
    f"""WITH {_SQL_ITEMS}
SELECT 'news-' || news_id AS id, 'news' AS type, published_at AS date, publisher AS source, NULL AS security_code FROM c
UNION ALL SELECT 'announcement-' || news_id, 'announcement', published_at, 'news', CASE WHEN source_security_code[1:1] IN ('6', '5') THEN source_security_code || '.SH' ELSE source_security_code || '.SZ' END FROM c
UNION ALL SELECT 'document-reports/2026/0' || (doc_id % 9 + 1) || '/11/' || doc_id || '.md', 'daily', '2026-0' || (doc_id % 9 + 1) || '-11', 'repository', NULL FROM documents WHERE text IS NOT NULL""",
)
def content_feed(spark: SparkSession, folder: str) -> DataFrame:
    """News, announcements and reports under one schema."""
    rows, _ = ct.content_table(_items(spark, folder), "news", "news_id", with_publisher=True)
    frames = [ct.feed_rows(rows, "news", "news_id"), ct.feed_rows(rows.drop("publisher"), "announcement", "news_id"), ct.document_rows(_reports(spark, folder))]
    return ct.feed(frames).select("id", "type", "date", "source", "security_code")
