"""Version, content, key, page, reconciliation and portfolio queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import content as ct
from tidemark.operators import coverage as cv
from tidemark.operators import jobs as jb
from tidemark.operators import portfolio as pf
from tidemark.operators import quality as q
from tidemark.operators import scan
from tidemark.operators import versions as v
from tidemark.plans import marts
from tidemark.plans.registry import register, table

#: The rules of the taxonomy query; the first with a hit wins.
TEXT_RULES = [
    ("licensed", ["License", "CC BY"]),
    ("listed", [" | "]),
    ("marked", ["***", "%%%", "$$$", "###"]),
]


# --- versions -----------------------------------------------------------------------
@register(
    "latest_version",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    newest = v.latest_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@register(
    "multi_batch_latest",
    """SELECT user_id, event_id, kind FROM (
  SELECT user_id, event_id, ts, event_type AS kind FROM events
  UNION ALL SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, kind DESC) = 1""",
)
def multi_batch_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of a key over batches of two tables."""
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("kind"))
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("kind"),
    )
    return v.union_latest([events, orders], ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "kind")


@register(
    "first_wins_dedup",
    """SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def first_wins_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts")
    return v.first_by(events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@register(
    "latest_fetch_dedup",
    """SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_fetch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", F.col("ts").alias("fetched_at"))
    return ct.latest_fetch(events, "user_id").select("user_id", "event_id")


@register(
    "latest_slice",
    """SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_suppkey)""",
)
def latest_slice(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return v.latest_slice(rows, ["l_suppkey"], "l_shipdate").select("l_suppkey", "l_orderkey", "l_linenumber")


@register(
    "content_dedup_merge",
    """WITH d AS (SELECT left(sha256(lower(text)), 24) AS id, lang, text AS summary FROM documents),
g AS (SELECT id, count(*) AS copies, count(DISTINCT lang) AS langs, min(lang) AS lang FROM d GROUP BY 1),
s AS (SELECT id, summary FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(summary) DESC, summary) = 1)
SELECT id, CASE WHEN langs > 1 THEN 'conflict' ELSE 'merged' END AS outcome,
  CASE WHEN langs > 1 THEN NULL ELSE sha256(summary) END AS summary_sha256 FROM g JOIN s USING (id)""",
)
def content_dedup_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that differ in case alone share an id; the longest, then smallest one stays."""
    docs = table(spark, folder, "documents").select(
        F.substring(F.sha2(F.lower("text"), 256), 1, 24).alias("id"), "lang", F.col("text").alias("summary")
    )
    merged, conflicts = v.merge_duplicates(docs, "id", ["summary"])
    return merged.select("id", F.lit("merged").alias("outcome"), F.sha2("summary", 256).alias("summary_sha256")).unionByName(
        conflicts.select("id", F.lit("conflict").alias("outcome"), F.lit(None).cast("string").alias("summary_sha256"))
    )


# --- content ------------------------------------------------------------------------
@register(
    "event_taxonomy",
    """SELECT doc_id, CASE WHEN contains(text, 'License') OR contains(text, 'CC BY') THEN 'licensed'
  WHEN contains(text, ' | ') THEN 'listed'
  WHEN contains(text, '***') OR contains(text, '%%%') OR contains(text, '$$$') OR contains(text, '###') THEN 'marked'
  ELSE 'plain' END AS event_type FROM documents""",
)
def event_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    kind, _ = ct.classify(F.col("text"), TEXT_RULES, "plain")
    return table(spark, folder, "documents").select("doc_id", kind.alias("event_type"))


@register(
    "daily_type_counts",
    "SELECT CAST(ts::DATE AS VARCHAR) AS report_date, event_type, count(*) AS record_count FROM events GROUP BY 1, 2",
)
def daily_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ct.daily_counts(table(spark, folder, "events"), F.date_format("ts", "yyyy-MM-dd"))


@register(
    "or_join_related",
    """WITH names AS (SELECT n_nationkey AS security_code, r_name AS security_name FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey AS id, c_nationkey AS security_code, security_name FROM customer JOIN names ON (c_nationkey + 1) % 25 = names.security_code)
SELECT security_code, id FROM c UNION
SELECT n.security_code, id FROM c JOIN names n ON c.security_name = n.security_name""",
)
def or_join_related(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of a nation, by its key or by the name of a region, which several nations share."""
    names = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("security_code"), F.col("r_name").alias("security_name"))
    )
    named = names.select(F.col("security_code").alias("next"), "security_name")
    items = (
        table(spark, folder, "customer")
        .join(named, (F.col("c_nationkey") + 1) % 25 == F.col("next"))
        .select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("security_code"), "security_name")
    )
    return ct.related(items, names)


@register(
    "id_hash",
    "SELECT page_id, left(sha256(concat('pages', chr(0), url, chr(0), page_id::VARCHAR, chr(0), html)), 24) AS id FROM pages",
)
def id_hash(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    key = tx.content_id("pages", F.col("url"), F.col("page_id").cast("string"), F.col("html"))
    return pages.select("page_id", key.alias("id"))


@register("hash_shards", "SELECT left(sha256(doc_id::VARCHAR), 1) AS shard, count(*) AS record_count FROM documents GROUP BY 1")
def hash_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(tx.shard_of(F.col("doc_id").cast("string")).alias("shard"))
    return docs.groupBy("shard").agg(F.count("*").alias("record_count"))


@register(
    "safe_urls",
    r"SELECT page_id, regexp_matches(url, '^https?://[a-z0-9.\-]+\.(com|net|org)([/?#].*)?$') AS public FROM pages",
)
def safe_urls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", tx.public_url(F.col("url")).alias("public"))


@register("conversation_scan")
def conversation_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Findings per message; the detectors' patterns look around, which DuckDB's do not."""
    return scan.scan_text(table(spark, folder, "conversations"), ["conv_id", "turn"], "text")


@register("doc_scan")
def doc_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan.scan_text(table(spark, folder, "documents"), ["doc_id"], "text")


@register(
    "duplicate_texts",
    "SELECT sha256(text) AS text_sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text",
)
def duplicate_texts(spark: SparkSession, folder: str) -> DataFrame:
    return v.duplicate_text(table(spark, folder, "documents"), "doc_id", "text", ["doc_id"])


# --- keys and references ------------------------------------------------------------
@register(
    "dup_keys",
    "SELECT l_partkey, l_suppkey, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dup_keys(spark: SparkSession, folder: str) -> DataFrame:
    return q.duplicate_keys(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])


@register(
    "pk_complete",
    """SELECT 'lineitem' AS table_name, count(*) AS row_count, count(DISTINCT (l_partkey, l_suppkey)) AS key_count, 0::BIGINT AS incomplete_count,
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1)) AS duplicate_key_count FROM lineitem""",
)
def pk_complete(spark: SparkSession, folder: str) -> DataFrame:
    return q.key_report(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"], "lineitem")


@register(
    "ri_orphans",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def ri_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of customers that are not among those with a positive balance."""
    paying = table(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return q.orphans(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), paying, ["o_custkey"]).select(
        "o_orderkey", "o_custkey"
    )


@register(
    "reconcile_full_outer",
    """WITH r AS (SELECT l_orderkey AS k, CASE WHEN min(l_linestatus) <> max(l_linestatus) THEN 'P' ELSE min(l_linestatus) END AS s FROM lineitem GROUP BY 1)
SELECT coalesce(o_orderkey, k) AS order_key, CASE WHEN k IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only'
  WHEN o_orderstatus IS NOT DISTINCT FROM s THEN 'match' ELSE 'conflict' END AS status
FROM orders FULL JOIN r ON o_orderkey = k""",
)
def reconcile_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    """The status of an order against that of its lines."""
    said = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("order_status")
    )
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_key"))
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    found = lines.agg(F.when(low != high, F.lit("P")).otherwise(low).alias("order_status"))
    return q.reconcile(said, found, ["order_key"], ["order_status"]).select("order_key", "status")


# --- pages --------------------------------------------------------------------------
@register(
    "page_completeness",
    """SELECT l_orderkey, count(DISTINCT l_linenumber) AS page_count, min(l_linenumber)::BIGINT AS first_page, max(l_linenumber)::BIGINT AS last_page,
  count(*) = count(DISTINCT l_linenumber) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(DISTINCT l_linenumber)
    AND count(DISTINCT l_linenumber) = 7 AND count(*) = 7 AS complete
FROM lineitem GROUP BY 1""",
)
def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of an order as pages of one row; an order can have seven."""
    pages = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("page"),
        F.lit(1).alias("page_limit"),
        F.lit(7).alias("total"),
        F.lit(1).alias("returned"),
    )
    return q.page_summary(pages, ["l_orderkey"]).select("l_orderkey", "page_count", "first_page", "last_page", "complete")


@register(
    "page_gaps",
    """WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS page FROM lineitem WHERE l_returnflag <> 'R'),
b AS (SELECT *, coalesce(lag(page) OVER (PARTITION BY l_orderkey ORDER BY page), 0) AS before FROM p)
SELECT l_orderkey, before + 1 AS gap_start, page - 1 AS gap_end FROM b WHERE page > before + 1""",
)
def page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of line numbers that returned goods leave open."""
    kept = table(spark, folder, "lineitem").where("l_returnflag <> 'R'")
    return q.page_gaps(kept.select("l_orderkey", F.col("l_linenumber").alias("page")), ["l_orderkey"])


@register(
    "has_more_consistency",
    """SELECT l_orderkey, l_linenumber FROM lineitem
QUALIFY (l_linestatus = 'O') <> (l_linenumber < max(l_linenumber) OVER (PARTITION BY l_orderkey))""",
)
def has_more_consistency(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linestatus") == "O").alias("has_more")
    )
    return q.has_more_conflicts(pages, ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_linenumber")


@register(
    "order_gate",
    """SELECT user_id, event_id, previous_event_id FROM (SELECT user_id, event_id,
  lag(event_id) OVER (PARTITION BY user_id ORDER BY value, event_id) AS previous_event_id FROM events) WHERE previous_event_id >= event_id""",
)
def order_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user, in order of value, whose id is not above the one before."""
    events = table(spark, folder, "events").select("user_id", "event_id", "value")
    rows = q.order_violations(events, ["user_id"], [F.col("value").asc_nulls_last(), F.col("event_id").asc()], "event_id")
    return rows.select("user_id", "event_id", "previous_event_id")


# --- bundles and portfolio ----------------------------------------------------------
@register(
    "best_bundle",
    """SELECT l_partkey, l_suppkey AS bundle, n AS record_count FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey DESC) = 1""",
)
def best_bundle(spark: SparkSession, folder: str) -> DataFrame:
    counts = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", F.col("l_suppkey").alias("bundle"))
        .agg(F.count("*").alias("record_count"))
    )
    return cv.best_bundle(counts, ["l_partkey"], "bundle", "record_count")


@register(
    "portfolio_weights",
    """SELECT s_suppkey, s_nationkey, CASE WHEN sum(s_acctbal::DECIMAL(28, 2)) OVER (PARTITION BY s_nationkey) > 0 THEN
  round(s_acctbal::DECIMAL(28, 2)::DOUBLE / (sum(s_acctbal::DECIMAL(28, 2)) OVER (PARTITION BY s_nationkey))::DOUBLE, 9) END AS actual_weight FROM supplier""",
)
def portfolio_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = pf.weights(table(spark, folder, "supplier"), "s_acctbal", "s_nationkey")
    return rows.select("s_suppkey", "s_nationkey", F.round("actual_weight", 9).alias("actual_weight"))


# --- rules, work and serving --------------------------------------------------------
@register(
    "rule_violations",
    """SELECT l_orderkey, l_linenumber, 'discount_above_tax' AS rule_id FROM lineitem WHERE l_discount > l_tax
UNION ALL SELECT l_orderkey, l_linenumber, 'few_pieces' FROM lineitem WHERE l_quantity < 5
UNION ALL SELECT l_orderkey, l_linenumber, 'returned_while_open' FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'""",
)
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        q.Rule("discount_above_tax", F.col("l_discount") > F.col("l_tax")),
        q.Rule("few_pieces", F.col("l_quantity") < 5),
        q.Rule("returned_while_open", (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")),
    ]
    return q.violations(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], rules)


@register(
    "work_discovery",
    """SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'up_to_date' ELSE 'planned' END AS work_status FROM documents""",
)
def work_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a label are done; the others are planned."""
    docs = table(spark, folder, "documents").select("doc_id")
    return jb.work_status(docs, table(spark, folder, "labels"), ["doc_id"])


@register(
    "company_360",
    """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS order_count,
  (SELECT count(*) FROM events WHERE user_id = c_custkey) AS event_count, left(sha256(c_custkey::VARCHAR), 1) AS detail_shard FROM customer""",
)
def company_360(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the numbers of their orders and events, each counted before it is joined."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    children = {
        "order": table(spark, folder, "orders").select(F.col("o_custkey").cast("string").alias("key")),
        "event": table(spark, folder, "events").select(F.col("user_id").cast("string").alias("key")),
    }
    index = marts.company_index(customers, children, "key")
    return index.select(F.col("key").cast("long").alias("c_custkey"), "order_count", "event_count", "detail_shard")

