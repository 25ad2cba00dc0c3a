"""Queries over field names, facts, typed values, quotes, portfolios, jobs, coverage and published sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import coerce as co
from tidemark.functions import names as nm
from tidemark.functions import text as tx
from tidemark.operators import content as ct
from tidemark.operators import coverage as cv
from tidemark.operators import jobs as jb
from tidemark.operators import normalize as nz
from tidemark.operators import portfolio as pf
from tidemark.operators import quality as qa
from tidemark.operators import versions as v
from tidemark.plans.registry import register, table
from tidemark.session import settle


def _choice(number: Column, options: list[Column | str | None]) -> Column:
    """The option at ``number`` modulo their count."""
    out = F.lit(None).cast("string")
    for i, option in enumerate(options):
        value = option if isinstance(option, Column) else F.lit(option)
        out = F.when(F.pmod(number, F.lit(len(options))) == i, value).otherwise(out)
    return out


# --- field names --------------------------------------------------------------------
def _order_fields(spark: SparkSession, folder: str) -> DataFrame:
    """A vendor field name for each order: base names by key, contexts from the order's date."""
    day = F.col("o_orderdate")
    base = _choice(F.col("o_orderkey"), ["营业收入", "收盘价", "股票代码", "某字段", "公告日期"])
    dated = lambda form, d: F.concat(F.lit("["), F.date_format(d, form), F.lit("]"))
    year = lambda end: F.concat(F.lit("["), F.date_format(day, "yyyy"), F.lit(end))
    quarter = F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    contexts = [None, dated("yyyyMMdd", day), dated("yyyy-MM-dd", day), year("年一季报]"), year("0230]"), "[abc]", dated("yyyyMMdd", quarter)]
    context = _choice(F.floor(F.col("o_orderkey") / 5), contexts)
    return table(spark, folder, "orders").select("o_orderkey", F.concat(base, F.coalesce(context, F.lit(""))).alias("raw_field_name"))


_SQL_FIELDS = """m(base, canonical, category) AS (VALUES ('营业收入', 'revenue', 'financial'), ('收盘价', 'close', 'market'), ('股票代码', 'security_code', 'identity'),
  ('公告日期', 'filing_date', 'financial_metadata')),
n AS (SELECT o_orderkey, (['营业收入', '收盘价', '股票代码', '某字段', '公告日期'])[o_orderkey % 5 + 1] AS base, o_orderkey // 5 % 7 AS c, o_orderdate::DATE AS day,
  (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS ends FROM orders),
x AS (SELECT *, CASE c WHEN 0 THEN NULL WHEN 1 THEN strftime(day, '%Y%m%d') WHEN 2 THEN strftime(day, '%Y-%m-%d') WHEN 3 THEN year(day) || '年一季报'
    WHEN 4 THEN year(day) || '0230' WHEN 5 THEN 'abc' ELSE strftime(ends, '%Y%m%d') END AS context,
  CASE WHEN c IN (1, 2) THEN strftime(day, '%Y-%m-%d') WHEN c = 6 THEN strftime(ends, '%Y-%m-%d') END AS dated FROM n),
p AS (SELECT o_orderkey, base, context, canonical, category, dated, c,
  dated IS NOT NULL AND coalesce(category LIKE 'financial%', false) AS as_period,
  CASE dated[6:10] WHEN '03-31' THEN 'Q1' WHEN '06-30' THEN 'H1' WHEN '09-30' THEN 'Q3' WHEN '12-31' THEN 'FY' END AS suffix FROM x LEFT JOIN m USING (base)),
f AS (SELECT *, CASE WHEN context IS NULL THEN 'none' WHEN as_period THEN 'financial_period_date' WHEN dated IS NOT NULL THEN 'date' WHEN c = 3 THEN 'report_period' ELSE 'unrecognized' END AS context_type FROM p)"""


@register(
    "field_name_parse",
    f"""WITH {_SQL_FIELDS}
SELECT o_orderkey, base AS base_field_name, context AS original_context, canonical AS canonical_field_name, context_type,
  CASE WHEN context_type = 'date' THEN dated END AS as_of_date,
  CASE WHEN as_period THEN dated WHEN c = 3 THEN context[1:4] || '-03-31' END AS period_end,
  CASE WHEN as_period THEN dated[1:4] || suffix WHEN c = 3 THEN context[1:4] || 'Q1' END AS report_type,
  CASE WHEN canonical IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status,
  CASE WHEN canonical IS NULL OR context_type = 'unrecognized' THEN 'low' WHEN context_type = 'none' THEN 'medium' ELSE 'high' END AS confidence,
  CASE WHEN c = 4 THEN 'invalid_date_context' END AS parse_error FROM f""",
)
def field_name_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = nm.parse_field_names(_order_fields(spark, folder), nm.mapping_frame(spark))
    return parsed.select(
        "o_orderkey", "base_field_name", "original_context", "canonical_field_name", "context_type", "as_of_date", "period_end",
        "report_type", "mapping_status", "confidence", "parse_error",
    )


@register(
    "mapping_coverage",
    f"""WITH {_SQL_FIELDS}, g AS (SELECT o_orderkey % 100 AS snapshot, * FROM f)
SELECT snapshot, count(*) AS field_count, count(canonical) AS mapped_count, count(*) - count(canonical) AS unmapped_count, count(*) FILTER (WHERE c = 4) AS error_count FROM g GROUP BY 1""",
)
def mapping_coverage(spark: SparkSession, folder: str) -> DataFrame:
    parsed = nm.parse_field_names(_order_fields(spark, folder), nm.mapping_frame(spark))
    return cv.mapping_coverage(parsed.withColumn("snapshot", F.col("o_orderkey") % 100), ["snapshot"])


@register(
    "unmapped_fields",
    """SELECT o_orderkey % 100 AS snapshot, '字段' || o_orderkey % 7 AS base_field_name, count(*) AS parts FROM orders WHERE o_orderkey % 7 > 1 GROUP BY 1, 2""",
)
def unmapped_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The union over parts of the names that no mapping knows."""
    number = F.col("o_orderkey") % 7
    name = F.when(number > 1, F.concat(F.lit("字段"), number.cast("string"))).otherwise(F.lit("营业收入"))
    fields = table(spark, folder, "orders").select((F.col("o_orderkey") % 100).alias("snapshot"), F.concat(name, F.lit("["), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("]")).alias("raw_field_name"))
    return cv.unmapped_fields(nm.parse_field_names(fields, nm.mapping_frame(spark)), ["snapshot"])


@register(
    "period_evidence",
    """WITH e AS (SELECT o_custkey, (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE::VARCHAR AS p, o_orderkey % 3 AS k FROM orders)
SELECT o_custkey, coalesce(list(DISTINCT p ORDER BY p) FILTER (WHERE k = 0), []) AS financial_periods, coalesce(list(DISTINCT p ORDER BY p) FILTER (WHERE k = 1), []) AS label_periods,
  coalesce(list(DISTINCT p ORDER BY p) FILTER (WHERE k = 2), []) AS filing_periods FROM e GROUP BY 1""",
)
def period_evidence(spark: SparkSession, folder: str) -> DataFrame:
    ends = F.date_format(F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2)), "'['yyyyMMdd']'")
    base = _choice(F.col("o_orderkey"), ["营业收入", "报告期", "公告日期"])
    fields = table(spark, folder, "orders").select("o_custkey", F.concat(base, ends).alias("raw_field_name"))
    return cv.period_evidence(nm.parse_field_names(fields, nm.mapping_frame(spark)), ["o_custkey"])


# --- facts --------------------------------------------------------------------------
def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """A vendor row of dynamic columns for each order: two figures of two periods, some blank, some not asked for."""
    order = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    code = F.concat(F.lpad((order % 1_000_000).cast("string"), 6, "0"), F.lit(".SZ"))
    figures = [
        (F.lit("股票代码"), code),
        (F.lit("股票简称"), F.concat(F.lit("n"), order.cast("string"))),
        (F.concat(F.lit("营业收入["), year, F.lit("1231]")), F.when(order % 7 != 0, price).otherwise(F.lit(""))),
        (F.concat(F.lit("总资产["), year, F.lit("1231]")), F.when(order % 5 != 0, price)),
        (F.concat(F.lit("公告日期["), year, F.lit("1231]")), F.when(order % 11 != 0, F.concat((F.year("o_orderdate") + 1).cast("string"), F.lit("0430")))),
        (F.concat(F.lit("报告期["), year, F.lit("1231]")), F.concat(year, F.when(order % 13 == 0, F.lit("年中报")).otherwise(F.lit("年年报")))),
        (F.concat(F.lit("存货["), year, F.lit("0630]")), F.lit("")),
    ]
    kept = F.array(*[F.when(F.lit(i != 3) | (order % 3 != 0), F.struct(n.alias("key"), F.to_variant_object(F.array(t)).alias("value"))) for i, (n, t) in enumerate(figures)])
    entries = F.transform(F.array_compact(kept), lambda e: F.struct(e["key"], F.variant_get(e["value"], "$[0]", "variant").alias("value")))
    return nz.spread(table(spark, folder, "orders"), ["o_orderkey"]).select(
        "o_orderkey", F.lit("2030-01-01 00:00:00").cast("timestamp").alias("fetched_at"), (order % 50).cast("string").alias("query_group"),
        order.cast("string").alias("raw_record_id"), F.map_from_entries(entries).alias("entries"),
    )


def _facts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    pages = _pages(spark, folder)
    names = pages.select(F.explode(F.map_keys("entries")).alias("raw_field_name")).distinct()
    descriptors = settle(nm.parse_field_names(names, nm.mapping_frame(spark)))  # of a known size, so broadcast if small
    keys = ["o_orderkey", "fetched_at", "raw_record_id", "query_group"]
    return nz.financial_tables(nz.described_cells(pages, descriptors, keys), ["o_orderkey"])


_SQL_FACTS = """o AS (SELECT o_orderkey AS k, year(o_orderdate) || '-12-31' AS period_end, o_totalprice::DECIMAL(18,2)::DOUBLE AS price FROM orders
  WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0),
f AS (SELECT k, period_end, 'revenue' AS field, CASE WHEN k % 7 <> 0 THEN price END AS value FROM o
  UNION ALL SELECT k, period_end, 'total_assets', CASE WHEN k % 5 <> 0 THEN price END FROM o WHERE k % 3 <> 0)"""


@register(
    "wide_to_long_facts",
    f"""WITH {_SQL_FACTS}
SELECT k AS o_orderkey, period_end, field AS canonical_field_name, value, CASE WHEN value IS NULL THEN 'missing_in_source' ELSE 'present' END AS value_status FROM f""",
)
def wide_to_long_facts(spark: SparkSession, folder: str) -> DataFrame:
    return _facts(spark, folder)["facts"].select("o_orderkey", "period_end", "canonical_field_name", "value", "value_status")


@register(
    "report_sides",
    """SELECT CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 13 = 0 THEN 'rejected' WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'rejected' ELSE 'report' END AS side, year(o_orderdate) || '-12-31' AS period_end, count(*) AS n
FROM orders GROUP BY 1, 2 UNION ALL SELECT 'missing', year(o_orderdate) || '-06-30', count(*) FROM orders GROUP BY 1, 2""",
)
def report_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Reports, reports the source does not have, and rejected ones, by period."""
    found = _facts(spark, folder)
    sides = [found[name].select(F.lit(side).alias("side"), "period_end") for name, side in (("reports", "report"), ("missing", "missing"), ("rejected", "rejected"))]
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("side", "period_end").agg(F.count(F.lit(1)).alias("n"))


@register(
    "grid_completion",
    f"""WITH {_SQL_FACTS}, g AS (SELECT *, k % 50 AS q FROM f),
t AS (SELECT DISTINCT q, period_end, field FROM g), r AS (SELECT k, k % 50 AS q, period_end FROM o),
m AS (SELECT r.k, r.q, r.period_end, t.field FROM r JOIN t USING (q, period_end) ANTI JOIN g ON g.k = r.k AND g.field = t.field),
u AS (SELECT q, field, value IS NOT NULL AS present, 'source_row' AS role FROM g UNION ALL SELECT q, field, false, 'query_batch_expected_field' FROM m)
SELECT q::VARCHAR AS query_group, field AS canonical_field_name, role AS source_role, count(*) AS fact_count, count(*) FILTER (WHERE present) AS present_fact_count,
  count(*) FILTER (WHERE NOT present) AS missing_fact_count FROM u GROUP BY 1, 2, 3""",
)
def grid_completion(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of every report, with those that other reports of its query and period have, counted."""
    found = _facts(spark, folder)
    grid = nz.complete_grid(found["facts"], found["reports"], ["query_group", "period_end"], ["o_orderkey", "period_end"])
    return cv.fact_coverage(grid, ["query_group", "canonical_field_name", "source_role"])


# --- typed values -------------------------------------------------------------------
@register(
    "typed_values",
    r"""WITH t AS (SELECT o_orderkey AS k, o_totalprice::DECIMAL(18,2)::VARCHAR AS price, o_orderdate::DATE AS day FROM orders),
c AS (SELECT k, CASE k % 6 WHEN 0 THEN price WHEN 1 THEN ' ' || price || ' ' WHEN 2 THEN 'NaN' WHEN 3 THEN '' WHEN 4 THEN 'true' ELSE '-1.5e3' END AS n,
  CASE k % 4 WHEN 0 THEN strftime(day, '%Y%m%d') WHEN 1 THEN '20230230' WHEN 2 THEN strftime(day, '%Y-%m-%d') ELSE 'x' END AS d,
  CASE k % 3 WHEN 0 THEN '6' ELSE '0' END || lpad((k % 100000)::VARCHAR, 5, '0') AS code, day FROM t)
SELECT k AS o_orderkey, CASE k % 6 WHEN 0 THEN n::DOUBLE WHEN 1 THEN trim(n)::DOUBLE WHEN 5 THEN -1500.0 END AS number, k % 6 IN (2, 4) AS rejected,
  CASE k % 4 WHEN 0 THEN day END AS compact_date, CASE WHEN k % 4 IN (0, 2) THEN day END AS loose_date,
  code || CASE WHEN k % 3 = 0 THEN '.SH' ELSE '.SZ' END AS listed, CASE WHEN k % 3 = 0 THEN 'SH' ELSE 'SZ' END AS exchange,
  strftime(day, '%Y-%m-%d') || 'T08:30:00+08:00' AS local FROM c""",
)
def typed_values(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers, dates, codes and instants from texts, rejects among them."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = _choice(k, [price, F.concat(F.lit(" "), price, F.lit(" ")), "NaN", "", "true", "-1.5e3"])
    date = _choice(k, [F.date_format(day, "yyyyMMdd"), "20230230", F.date_format(day, "yyyy-MM-dd"), "x"])
    code = co.listed_code(F.concat(F.when(k % 3 == 0, F.lit("6")).otherwise(F.lit("0")), F.lpad((k % 100_000).cast("string"), 5, "0")))
    moment = _choice(k, [F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:30:00Z")), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:30:00"))])
    return table(spark, folder, "orders").select(
        "o_orderkey", co.number(text).alias("number"), co.number_rejected(text).alias("rejected"), co.compact_date(date).alias("compact_date"),
        co.loose_date(date).alias("loose_date"), code.alias("listed"), co.exchange_suffix(code).alias("exchange"), co.zone_text(co.instant(moment)).alias("local"),
    )


@register(
    "text_values",
    r"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS compact, list_aggregate(list_distinct(list_filter([trim(lang), '', trim(source), trim(lang)], lambda x: x <> '')), 'count')::INTEGER AS memberships,
  upper(replace(source, '_', '')) AS index_key, contains(lower(source || ' ' || coalesce(text, '')), 'the') AS matches FROM documents""",
)
def text_values(spark: SparkSession, folder: str) -> DataFrame:
    """Compact texts, membership lists, index keys and search matches over whole documents."""
    listed = co.membership_text(F.concat(F.lit(" "), "lang", F.lit(" ; ;"), "source", F.lit(";"), "lang"))
    return table(spark, folder, "documents").select(
        "doc_id", tx.compact_text(F.col("text")).alias("compact"), F.size(listed).alias("memberships"),
        nm.index_key(F.col("source")).alias("index_key"), tx.search_match(" The ", F.col("source"), F.col("text")).alias("matches"),
    )


# --- quotes and portfolios ----------------------------------------------------------
def _quotes(spark: SparkSession, folder: str) -> DataFrame:
    """The newest price of each part's code over bars and fund snapshots, which name their columns differently."""
    lines = table(spark, folder, "lineitem")
    code = F.lpad((F.col("l_partkey") % 900 + 600_000).cast("string"), 6, "0")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    price = F.col("l_extendedprice") + F.col("l_linenumber") / 1000
    bars = lines.where("l_linenumber <= 4").select(code.alias("security_code"), F.when(F.col("l_tax") > 0, price).alias("close"), day.alias("trade_date"), F.lit("HKD").alias("currency"))
    funds = lines.where("l_linenumber > 4").select(F.concat(code, F.lit(".SH")).alias("fund_code"), price.alias("unit_net_value"), day.alias("nav_date"), F.lit("funds").alias("source"))
    return v.latest_quote([bars, funds])


_SQL_QUOTES = """q AS (SELECT (l_partkey % 900 + 600000) || '.SH' AS security_code, CASE WHEN l_linenumber > 4 OR l_tax > 0 THEN l_extendedprice + l_linenumber / 1000 END AS close,
  l_shipdate::DATE::VARCHAR AS trade_date, CASE WHEN l_linenumber <= 4 THEN 'HKD' ELSE 'CNY' END AS currency, CASE WHEN l_linenumber <= 4 THEN 'repository' ELSE 'funds' END AS source FROM lineitem),
l AS (SELECT * FROM q WHERE close IS NOT NULL QUALIFY row_number() OVER (PARTITION BY security_code ORDER BY trade_date DESC, close DESC, currency DESC, source DESC) = 1)"""


@register("latest_quote", f"WITH {_SQL_QUOTES} SELECT security_code, close, trade_date, currency, source FROM l")
def latest_quote(spark: SparkSession, folder: str) -> DataFrame:
    return _quotes(spark, folder).select("security_code", "close", "trade_date", "currency", "source")


def _holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Positions: parts held on three days."""
    part, key = table(spark, folder, "part"), F.col("p_partkey")
    return part.select(
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (key % 3).cast("int")), "yyyy-MM-dd").alias("as_of_date"),
        F.when(key % 2 == 0, (key + 600_000).cast("string")).otherwise(F.concat((key + 600_000).cast("string"), F.lit(".SH"))).alias("security_code"),
        F.col("p_name").alias("security_name"), (F.col("p_size") * 100).cast("double").alias("quantity"), F.col("p_retailprice").alias("average_cost"),
        F.lit("CNY").alias("currency"), F.lit(0.01).alias("target_weight"), F.when(key % 5 == 0, F.lit(7.25)).alias("latest_price"),
        F.when(key % 5 == 0, F.when(key % 10 == 0, F.lit("2030-01-01")).otherwise(F.lit("1990-01-01"))).alias("quote_date"), F.when(key % 5 == 0, F.lit("file")).alias("quote_source"),
    )


_SQL_POSITIONS = f"""{_SQL_QUOTES},
h AS (SELECT p_partkey AS k, (DATE '2000-01-01' + (p_partkey % 3)::INTEGER)::VARCHAR AS as_of_date,
  (p_partkey + 600000) || CASE WHEN p_partkey % 2 <> 0 THEN '.SH' WHEN NOT regexp_full_match((p_partkey + 600000)::VARCHAR, '[0-9]{{6}}') THEN ''
    WHEN left((p_partkey + 600000)::VARCHAR, 1) IN ('6', '5') THEN '.SH' ELSE '.SZ' END AS code, p_size * 100.0 AS quantity, p_retailprice AS cost,
  CASE WHEN p_partkey % 5 = 0 THEN 7.25 END AS old, CASE WHEN p_partkey % 10 = 0 THEN '2030-01-01' WHEN p_partkey % 5 = 0 THEN '1990-01-01' END AS old_date FROM part),
j AS (SELECT h.*, close IS NOT NULL AND coalesce(trade_date > old_date, true) AS newer, close, trade_date, source FROM h LEFT JOIN l ON l.security_code = h.code),
v AS (SELECT k, as_of_date, code AS security_code, round(quantity * cost, 2) AS cost_basis, CASE WHEN newer THEN close ELSE old END AS latest_price, CASE WHEN newer THEN trade_date ELSE old_date END AS quote_date,
  CASE WHEN newer THEN source WHEN old IS NOT NULL THEN 'file' END AS quote_source, quantity FROM j)"""


@register(
    "portfolio_valuation",
    f"""WITH {_SQL_POSITIONS} SELECT as_of_date, security_code, cost_basis, latest_price, quote_date, quote_source, round(quantity * latest_price, 2) AS market_value,
  CASE WHEN latest_price IS NULL THEN 'missing' ELSE 'available' END AS quote_status FROM v""",
)
def portfolio_valuation(spark: SparkSession, folder: str) -> DataFrame:
    """Positions with their newest price; those that were quoted already keep a newer one."""
    valued = pf.value_positions(_holdings(spark, folder), _quotes(spark, folder))
    return valued.select("as_of_date", "security_code", "cost_basis", "latest_price", "quote_date", "quote_source", "market_value", "quote_status")


@register(
    "valuation_summary",
    f"""WITH {_SQL_POSITIONS} SELECT as_of_date, count(*) AS position_count, sum(cost_basis::DECIMAL(28,2))::DOUBLE AS cost_basis,
  sum(coalesce(round(quantity * latest_price, 2), 0)::DECIMAL(28,2))::DOUBLE AS covered_value, count(latest_price) AS quotes_available FROM v GROUP BY 1""",
)
def valuation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return pf.valuation_summary(pf.value_positions(_holdings(spark, folder), _quotes(spark, folder)))


@register(
    "portfolio_review",
    """WITH h AS (SELECT c_custkey AS k, c_nationkey AS day, c_mktsegment AS segment, greatest(c_acctbal, 0)::DECIMAL(28,2) AS value FROM customer),
w AS (SELECT *, CASE WHEN sum(value) OVER (PARTITION BY day) > 0 THEN value::DOUBLE / (sum(value) OVER (PARTITION BY day))::DOUBLE END AS weight, segment <> 'FURNITURE' AS carded,
  (['intact', 'broken', 'weakened', 'intact'])[k % 4 + 1] AS thesis, (['attractive', 'fair', 'expensive'])[k % 3 + 1] AS worth, (['stable', 'material', 'stable', 'elevated', 'stable'])[k % 5 + 1] AS risk, (k % 7) / 200 AS target FROM h)
SELECT k::VARCHAR AS security_code, day AS as_of_date, round(weight, 12) AS actual_weight, CASE WHEN carded THEN target END AS target_weight,
  CASE WHEN NOT carded THEN 'REVIEW' WHEN thesis = 'broken' THEN 'EXIT_candidate' WHEN risk = 'material' THEN 'TRIM_candidate'
    WHEN thesis = 'intact' AND worth = 'attractive' AND weight < target - {t} THEN 'ADD_candidate' WHEN worth = 'expensive' AND weight > target + {t} THEN 'TRIM_candidate'
    WHEN thesis = 'intact' AND risk = 'stable' AND worth <> 'expensive' THEN 'HOLD' ELSE 'REVIEW' END AS category FROM w""".format(t=pf.WEIGHT_TOLERANCE),
)
def portfolio_review(spark: SparkSession, folder: str) -> DataFrame:
    """A category for each holding, from its weight and its card, which one segment lacks."""
    k = F.col("c_custkey")
    customers = table(spark, folder, "customer")
    holdings = customers.select(
        k.cast("string").alias("security_code"), F.col("c_name").alias("security_name"), F.col("c_nationkey").alias("as_of_date"), F.greatest("c_acctbal", F.lit(0.0)).alias("market_value")
    )
    cards = customers.where("c_mktsegment <> 'FURNITURE'").select(
        k.cast("string").alias("security_code"), _choice(k, ["intact", "broken", "weakened", "intact"]).alias("thesis_status"), _choice(k, ["attractive", "fair", "expensive"]).alias("valuation_status"),
        _choice(k, ["stable", "material", "stable", "elevated", "stable"]).alias("risk_status"), (k % 7 / 200).alias("target_weight"), F.lit("2026-01-01").alias("updated_at"),
    )
    return pf.portfolio_review(holdings, cards).select("security_code", "as_of_date", "actual_weight", "target_weight", "category")


# --- jobs ---------------------------------------------------------------------------
@register(
    "job_status",
    """WITH p AS (SELECT p_size AS job, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) - 1 AS place, count(*) OVER (PARTITION BY p_size) AS total FROM part),
g AS (SELECT job, place // 10 + 1 AS page, total, count(*) AS returned, job % 6 = 0 AND place // 10 = 0 AS twice FROM p WHERE NOT (job % 5 = 0 AND place // 10 = 1) GROUP BY ALL),
s AS (SELECT job, count(*) + count(*) FILTER (WHERE twice) AS snapshots, count(*) AS pages, min(page) AS first, max(page) AS last, min(total) AS total, sum(returned) AS uniq, sum(returned) + coalesce(sum(returned) FILTER (WHERE twice), 0) AS returned,
  bool_or(twice) AS dup FROM g GROUP BY 1),
j AS (SELECT DISTINCT p_size AS job FROM part UNION SELECT 1000),
e AS (SELECT j.job, s.*, ceil(total / 10)::BIGINT AS expected, first = 1 AND last = pages AS contiguous FROM j LEFT JOIN s USING (job)),
x AS (SELECT *, NOT dup AND contiguous AND pages = expected AS whole, list_filter([CASE WHEN job % 7 = 0 THEN 'collection_job_query_drift' END, CASE WHEN dup THEN 'duplicate_pages' END,
  CASE WHEN dup THEN 'duplicate_security_codes' END, CASE WHEN NOT contiguous THEN 'non_contiguous_pages' END, CASE WHEN total < 20 THEN 'below_minimum_expected_count' END], lambda v: v IS NOT NULL) AS errs FROM e)
SELECT job::VARCHAR AS job_id, CASE WHEN snapshots IS NULL THEN 'not_started' WHEN job % 7 = 0 OR dup OR total < 20 THEN 'quarantined' WHEN whole AND len(errs) = 0 THEN 'complete' ELSE 'partial' END AS status,
  coalesce(snapshots, 0)::BIGINT AS snapshot_count, coalesce(pages, 0)::BIGINT AS present_page_count, coalesce(returned, 0)::BIGINT AS returned_row_count, coalesce(uniq, 0)::BIGINT AS unique_security_count,
  CASE WHEN snapshots IS NULL THEN 1 WHEN len(errs) = 0 AND contiguous AND NOT whole THEN pages + 1 END::BIGINT AS next_page,
  CASE WHEN snapshots IS NULL THEN '' ELSE array_to_string(list_sort(errs), ',') END AS errors FROM x""",
)
def job_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status of paged jobs made of the parts of each size; some lack a page, have one twice, or drifted."""
    from tidemark.operators.ordering import ranked

    placed = ranked(table(spark, folder, "part").select("p_size", "p_partkey"), ["p_partkey"], by=["p_size"], rank="at", size="total")
    job, page = F.col("p_size"), F.floor((F.col("at") - 1) / 10).cast("int") + 1
    members = placed.withColumn("page", page).where(~((job % 5 == 0) & (F.col("page") == 2)))
    members = members.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when((job % 6 == 0) & (F.col("page") == 1), F.lit(2)).otherwise(F.lit(1)))))
    name = job.cast("string").alias("job_id")
    errors = F.when(job % 7 == 0, F.array(F.lit("collection_job_query_drift"))).otherwise(F.array().cast("array<string>"))
    snapshots = members.groupBy("p_size", "page", "copy").agg(F.count(F.lit(1)).alias("returned"), F.first("total").alias("total")).select(
        name, F.concat_ws("-", "page", "copy").alias("record_id"), "page", F.lit(10).alias("page_limit"), "total", "returned", errors.alias("errors")
    )
    jobs = placed.select(name).distinct().unionByName(spark.range(1).select(F.lit("1000").alias("job_id"))).withColumn("minimum_expected_count", F.lit(20))
    found = jb.job_status(jobs, snapshots, members.select(name, F.col("p_partkey").cast("string").alias("code")))
    return found.select(
        "job_id", "status", "snapshot_count", "present_page_count", "returned_row_count", "unique_security_count", "next_page", F.array_join("errors", ",").alias("errors")
    )


@register(
    "import_assessment",
    """WITH c AS (SELECT o_custkey AS k, count(*) AS n, count(DISTINCT o_orderkey % 40) AS uniq FROM orders WHERE o_orderkey % 19 <> 0 GROUP BY 1),
a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT o_custkey AS k, count(*) AS bad FROM orders WHERE o_orderkey % 19 = 0 GROUP BY 1),
r AS (SELECT k, coalesce(n, 0) AS n, coalesce(uniq, 0) AS uniq, coalesce(bad, 0) AS bad FROM a LEFT JOIN c USING (k) LEFT JOIN b USING (k)),
x AS (SELECT k, list_sort(list_filter([CASE WHEN k % 11 = 0 THEN 'financial_job_contract_missing' END, CASE WHEN k % 11 <> 0 AND n + bad = 10 THEN 'financial_job_unknown' END,
  CASE WHEN k % 11 <> 0 AND n + bad <> 10 AND k % 5 = 0 THEN 'financial_plan_query_hash_mismatch' END, CASE WHEN k % 11 <> 0 AND n + bad <> 10 AND k % 7 = 0 THEN 'financial_plan_period_mismatch' END,
  CASE WHEN k % 11 <> 0 AND k % 7 = 0 THEN 'financial_period_mismatch' END, CASE WHEN k % 11 <> 0 AND k % 7 = 0 THEN 'financial_report_period_label_mismatch' END,
  CASE WHEN k % 11 <> 0 AND k % 7 = 0 THEN 'financial_filing_date_period_mismatch' END, CASE WHEN bad > 0 THEN 'financial_security_code_missing' END,
  CASE WHEN uniq <> n THEN 'financial_duplicate_security_codes' END, CASE WHEN uniq <> n + bad THEN 'financial_unique_security_count_mismatch' END], lambda v: v IS NOT NULL)) AS reasons FROM r)
SELECT k::VARCHAR AS collection_id, CASE WHEN len(reasons) > 0 THEN 'quarantined_raw_only' ELSE 'ready_to_normalize' END AS status, array_to_string(reasons, ',') AS blocked_reasons FROM x""",
)
def import_assessment(spark: SparkSession, folder: str) -> DataFrame:
    """Blocking reasons of collections, one of each customer's orders, from contract, plan and rows."""
    k = F.col("o_custkey")
    orders = table(spark, folder, "orders")
    rows = orders.select(
        k.cast("string").alias("collection_id"),
        F.when(F.col("o_orderkey") % 19 != 0, F.parse_json(F.concat(F.lit('{"股票代码": "'), F.col("o_orderkey") % 40, F.lit('"}')))).otherwise(F.parse_json(F.lit('{"other": 1}'))).alias("row"),
    )
    each = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("int").alias("n"))
    period = F.when(k % 7 == 0, F.lit("2025-06-30")).otherwise(F.lit("2025-12-31"))
    query = F.concat(F.lit("q"), k.cast("string"))
    contract = lambda c: F.when(k % 11 != 0, c)
    seen = F.array(F.lit("2025-12-31"))
    collections = each.select(
        k.cast("string").alias("collection_id"), query.alias("query"), contract(F.concat(F.lit("j"), k.cast("string"))).alias("job_id"), contract(F.lit(1)).alias("request_version"),
        contract(period).alias("expected_period_end"), contract(F.sha2(F.when(k % 5 == 0, F.lit("x")).otherwise(query), 256)).alias("query_sha256"),
        seen.alias("financial_periods"), seen.alias("label_periods"), seen.alias("filing_periods"),
    )
    plan = each.where("n <> 10").select(
        F.concat(F.lit("j"), k.cast("string")).alias("job_id"), F.lit(1).alias("request_version"), F.lit("2025-12-31").alias("period_end"), query.alias("query"), F.lit(0).alias("minimum_expected_count")
    )
    responses = each.select(
        k.cast("string").alias("collection_id"), F.lit(1).alias("request_page"), F.lit(1_000_000).alias("request_limit"), F.col("n").alias("code_count"), F.col("n").alias("returned"),
        F.lit(True).alias("success"), F.lit(0).alias("status_code"),
    )
    found = jb.assess_collections(collections, plan, responses, rows)
    return found.select("collection_id", "status", F.array_join("blocked_reasons", ",").alias("blocked_reasons"))


@register(
    "snapshot_history",
    """WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey % 50 END AS job, o_orderkey % 4 AS version, o_orderpriority AS query, o_orderkey % 17 AS f FROM orders),
h AS (SELECT range AS job, unnest([1, 2]) AS version, unnest(['1-URGENT', '2-HIGH']) AS query FROM range(50) WHERE range % 2 = 0)
SELECT job_id, count(*) AS snapshot_count, count(DISTINCT f) AS fingerprint_count FROM (
  SELECT s.job AS job_id, f FROM s JOIN h ON s.job = h.job AND s.version = h.version AND s.query = h.query
  UNION ALL SELECT h.job, f FROM s JOIN h ON s.query = h.query WHERE s.job IS NULL) GROUP BY 1""",
)
def snapshot_history(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots and fingerprints of what jobs asked in earlier versions."""
    k = F.col("o_orderkey")
    snapshots = table(spark, folder, "orders").select(
        F.when(k % 3 > 0, F.col("o_custkey") % 50).alias("job_id"), (k % 4).cast("int").alias("request_version"), F.col("o_orderpriority").alias("query"), (k % 17).alias("fingerprint")
    )
    history = F.array(*[F.struct(F.lit(n).alias("request_version"), F.lit(q).alias("query")) for n, q in ((1, "1-URGENT"), (2, "2-HIGH"))])
    jobs = table(spark, folder, "orders").select((F.col("o_custkey") % 50).alias("job_id")).distinct()
    jobs = jobs.withColumn("historical_queries", F.when(F.col("job_id") % 2 == 0, history).otherwise(F.slice(history, 1, 0)))
    return jb.snapshot_summary(jb.historical_snapshots(snapshots, jobs))


# --- published sets -----------------------------------------------------------------
@register(
    "screen_set_faults",
    """WITH r AS (SELECT o_orderkey AS k, lpad((o_orderkey % 9000)::VARCHAR, 6, '30') || CASE WHEN o_orderkey % 5 = 0 THEN '.HK' ELSE '.SZ' END AS code, CASE o_orderkey % 4 WHEN 0 THEN 'x' WHEN 1 THEN '2026-08-06' ELSE '2026-08-07' END AS d FROM orders)
SELECT code, 'invalid_code' AS fault FROM r WHERE k % 5 = 0 UNION ALL SELECT code, 'outside_universe' FROM r WHERE k % 5 <> 0 AND left(code, 3) IN ('300', '301')
UNION ALL SELECT code, 'invalid_date' FROM r WHERE k % 4 = 0 UNION ALL SELECT code, 'date_mismatch' FROM r WHERE k % 4 = 1 UNION ALL SELECT code, 'repeated_code' FROM r GROUP BY 1 HAVING count(*) > 1""",
)
def screen_set_faults(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        F.concat(F.lpad((k % 9000).cast("string"), 6, "30"), F.when(k % 5 == 0, F.lit(".HK")).otherwise(F.lit(".SZ"))).alias("security_code"),
        _choice(k, ["x", "2026-08-06", "2026-08-07", "2026-08-07"]).alias("as_of_date"),
    )
    return qa.screen_set_faults(rows, F.lit("2026-08-07").cast("date"), ["SH", "SZ"], ["300", "301"])


@register(
    "fund_set_faults",
    """WITH r AS (SELECT c_custkey AS k, lpad((c_custkey % 1200)::VARCHAR, 6, '5') || '.SH' AS code, CASE WHEN c_custkey % 6 = 0 THEN 'SZ' ELSE 'SH' END AS exchange, CASE WHEN c_custkey % 7 = 0 THEN '2026-08-06' ELSE '2026-08-07' END AS d FROM customer)
SELECT code, 'universe_id_mismatch' AS fault FROM r WHERE k % 4 = 0 UNION ALL SELECT code, 'universe_version_mismatch' FROM r WHERE k % 9 = 0 UNION ALL SELECT code, 'invalid_code_or_exchange' FROM r WHERE k % 6 = 0
UNION ALL SELECT code, 'date_mismatch' FROM r WHERE k % 7 = 0 UNION ALL SELECT code, 'repeated_code_and_date' FROM r GROUP BY code, d HAVING count(*) > 1""",
)
def fund_set_faults(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        F.concat(F.lpad((k % 1200).cast("string"), 6, "5"), F.lit(".SH")).alias("etf_code"), F.when(k % 6 == 0, F.lit("SZ")).otherwise(F.lit("SH")).alias("exchange"),
        F.when(k % 4 != 0, F.lit("u")).alias("universe_id"), F.when(k % 9 == 0, F.lit("2")).otherwise(F.lit("1")).alias("universe_version"),
        F.when(k % 7 == 0, F.lit("2026-08-06")).otherwise(F.lit("2026-08-07")).alias("as_of_date"),
    )
    return qa.fund_set_faults(rows, "u", "1", ["SH", "SZ"], F.lit("2026-08-07").cast("date"))
