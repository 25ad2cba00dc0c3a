"""Screening, ranking and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.coerce import cap_band, iso_text
from tidemark.operators import metrics as m
from tidemark.operators import screening as sc
from tidemark.operators.ordering import percentile_scores, ranked
from tidemark.operators.versions import latest_known, latest_then_gate
from tidemark.plans import derived as d
from tidemark.plans.registry import register, table


def screen(spark: SparkSession, folder: str) -> DataFrame:
    part, lineitem = table(spark, folder, "part"), table(spark, folder, "lineitem")
    ratios = m.ratio_metrics(
        d.part_facts(lineitem), [x for x in fixed.RATIO_METRICS if x[0] in fixed.REQUIRED_METRICS]
    )
    return sc.composite_screen(d.security_master(part), d.valuations(lineitem), ratios, d.SCREEN_RULES)


@register(
    "screen_composite",
    d.SQL_SCREEN
    + """
SELECT c.code AS security_code, CAST(c.as_of AS VARCHAR) AS as_of_date, c.pe AS pe_ttm, c.cap AS market_cap,
  CASE WHEN NOT c.npm_missing AND NOT c.early THEN round(c.npm, 9) END AS net_profit_margin,
  CASE WHEN NOT c.ocfm_missing AND NOT c.early THEN round(c.ocfm, 9) END AS operating_cash_flow_margin,
  c.reasons AS eligibility_reasons, c.reasons = '' AS eligible, round(p.score, 9) AS score, p.rank,
  CASE WHEN p.rank IS NULL THEN 'Reject' WHEN (n - rank + 1) / n::DOUBLE >= 0.99 THEN 'P0'
       WHEN (n - rank + 1) / n::DOUBLE >= 0.90 THEN 'P1' ELSE 'P2' END AS priority
FROM cand c LEFT JOIN places p ON c.code = p.code
""",
)
def screen_composite(spark: SparkSession, folder: str) -> DataFrame:
    return screen(spark, folder).select(
        "security_code",
        iso_text(F.col("as_of_date")).alias("as_of_date"),
        "pe_ttm",
        "market_cap",
        F.round("net_profit_margin", 9).alias("net_profit_margin"),
        F.round("operating_cash_flow_margin", 9).alias("operating_cash_flow_margin"),
        F.concat_ws(",", "eligibility_reasons").alias("eligibility_reasons"),
        "eligible",
        F.round("score", 9).alias("score"),
        "rank",
        "priority",
    )


@register(
    "screen_counts",
    d.SQL_SCREEN
    + """, tiers AS (SELECT CASE WHEN p.rank IS NULL THEN 'Reject' WHEN (n - rank + 1) / n::DOUBLE >= 0.99 THEN 'P0'
       WHEN (n - rank + 1) / n::DOUBLE >= 0.90 THEN 'P1' ELSE 'P2' END AS priority
  FROM cand c LEFT JOIN places p ON c.code = p.code)
SELECT priority, count(*) AS record_count, round(count(*) * 100.0 / (SELECT count(*) FROM tiers), 6)::DOUBLE AS percent FROM tiers GROUP BY 1
""",
)
def screen_counts(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.session import settle

    counted = sc.priority_counts(settle(screen(spark, folder).select("priority")))
    return counted.select("priority", "record_count", F.round("percent", 6).alias("percent"))


@register(
    "eligibility_reasons",
    d.SQL_SCREEN + "SELECT code AS security_code, reasons AS eligibility_reasons FROM cand WHERE reasons <> ''",
)
def eligibility_reasons(spark: SparkSession, folder: str) -> DataFrame:
    part, lineitem = table(spark, folder, "part"), table(spark, folder, "lineitem")
    rows = sc.eligibility(
        d.security_master(part), d.valuations(lineitem), m.ratio_metrics(d.part_facts(lineitem)), d.SCREEN_RULES
    )
    return rows.where(~F.col("eligible")).select(
        "security_code", F.concat_ws(",", "eligibility_reasons").alias("eligibility_reasons")
    )


@register(
    "dashboard_page",
    d.SQL_SCREEN
    + """SELECT c.code AS security_code, CASE WHEN c.cap >= 5000000 THEN 'high' ELSE 'low' END AS band, p.rank
FROM cand c JOIN places p ON c.code = p.code WHERE c.code LIKE '%1%' AND p.score * 100 >= 40
ORDER BY p.rank, c.code LIMIT 50 OFFSET 50""",
)
def dashboard_page(spark: SparkSession, folder: str) -> DataFrame:
    """Second page of 50 of the filtered queue; the page is the feature."""
    rows = sc.dashboard_filter(screen(spark, folder), query="1", eligible=True, min_score=40)
    banded = rows.withColumn("band", F.when(F.col("market_cap") >= 5000000, F.lit("high")).otherwise(F.lit("low")))
    return sc.page(banded, "rank", 2, 50).select("security_code", "band", "rank")


@register(
    "universe_filter",
    f"""SELECT {d.SQL_CODE.format(k='p_partkey')} AS security_code,
  CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN 'suspended' ELSE 'listed' END AS listing_status
FROM part WHERE p_partkey % 4 <> 0 AND NOT regexp_matches(p_partkey::VARCHAR, '^(300|688)') AND p_type <> 'PROMO' AND p_size % 10 <> 1""",
)
def universe_filter(spark: SparkSession, folder: str) -> DataFrame:
    master = d.security_master(table(spark, folder, "part"))
    allowed = d.SCREEN_UNIVERSE.record_allowed(
        F.col("security_code"), F.col("market_memberships"), F.col("listing_status")
    )
    return master.where(allowed).select("security_code", "listing_status")


@register(
    "percentile_scores",
    """SELECT p_partkey, round((row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1) / (count(*) OVER () - 1)::DOUBLE, 9) AS high_score,
  round(1 - (row_number() OVER (ORDER BY p_size, p_partkey) - 1) / (count(*) OVER () - 1)::DOUBLE, 9) AS low_score FROM part""",
)
def percentile_query(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    high = percentile_scores(part, "p_retailprice", "p_partkey", "higher", score="high_score")
    both = percentile_scores(high, "p_size", "p_partkey", "lower", score="low_score")
    return both.select("p_partkey", F.round("high_score", 9).alias("high_score"), F.round("low_score", 9).alias("low_score"))


@register(
    "percentile_by_group",
    """SELECT p_partkey, p_type, round(CASE WHEN count(*) OVER (PARTITION BY p_type) = 1 THEN 1.0 ELSE
  (row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) - 1) / (count(*) OVER (PARTITION BY p_type) - 1)::DOUBLE END, 9) AS score FROM part""",
)
def percentile_by_group(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    return percentile_scores(part, "p_size", "p_partkey", by=["p_type"], score="score").select(
        "p_partkey", "p_type", F.round("score", 9).alias("score")
    )


@register(
    "priority_tiers",
    """WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank, count(*) OVER () AS n FROM customer)
SELECT c_custkey, rank, CASE WHEN (n - rank + 1) / n::DOUBLE >= 0.99 THEN 'P0' WHEN (n - rank + 1) / n::DOUBLE >= 0.90 THEN 'P1' ELSE 'P2' END AS priority FROM r""",
)
def priority_tiers(spark: SparkSession, folder: str) -> DataFrame:
    rows = ranked(
        table(spark, folder, "customer").select("c_custkey", "c_acctbal"),
        [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], size="n",
    )
    return rows.select(
        "c_custkey", "rank", sc.tier(F.col("rank"), F.col("n"), fixed.TIER_CUTS, fixed.LAST_TIER).alias("priority")
    )


@register(
    "cap_bands",
    """SELECT CASE WHEN o_totalprice * 300000 >= 1e11 THEN 'mega' WHEN o_totalprice * 300000 >= 3e10 THEN 'large' ELSE 'small' END AS band,
  count(*) AS orders FROM orders GROUP BY 1""",
)
def cap_bands(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(cap_band(F.col("o_totalprice") * 300000).alias("band"))
    return orders.groupBy("band").agg(F.count(F.lit(1)).alias("orders"))


# --- metrics ------------------------------------------------------------------------
@register(
    "ratio_metrics_long",
    f"""WITH {d.SQL_FACTS},
defs(metric_name, k) AS (VALUES ('net_profit_margin', 1), ('operating_cash_to_net_income', 2), ('operating_cash_flow_margin', 3),
  ('operating_profit_margin', 4), ('liability_to_assets', 5)),
pairs AS (SELECT code, period_end, available, metric_name,
  CASE k WHEN 1 THEN net_income WHEN 2 THEN cash WHEN 3 THEN cash END AS num,
  CASE k WHEN 1 THEN revenue WHEN 2 THEN net_income WHEN 3 THEN revenue WHEN 4 THEN revenue END AS den FROM facts, defs)
SELECT code AS security_code, CAST(period_end AS VARCHAR) AS period_end, metric_name, CAST(available AS VARCHAR) AS available_from,
  CASE WHEN num IS NULL OR den IS NULL THEN 'missing_inputs' WHEN den = 0 THEN 'zero_denominator' ELSE 'calculated' END AS calculation_status,
  CASE WHEN den <> 0 THEN round(num / den, 6) END AS value FROM pairs""",
)
def ratio_metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = m.ratio_metrics(d.part_facts(table(spark, folder, "lineitem")))
    return rows.select(
        "security_code",
        iso_text(F.col("period_end")).alias("period_end"),
        "metric_name",
        iso_text(F.col("available_from")).alias("available_from"),
        "calculation_status",
        F.round("value", 6).alias("value"),
    )


@register(
    "metric_coverage",
    f"""WITH {d.SQL_FACTS}, s AS (
  SELECT code, period_end, 'net_profit_margin' AS metric_name, revenue <> 0 AS ok FROM facts
  UNION ALL SELECT code, period_end, 'operating_cash_flow_margin', cash IS NOT NULL AND revenue <> 0 FROM facts
  UNION ALL SELECT code, period_end, 'operating_cash_to_net_income', cash IS NOT NULL AND net_income <> 0 FROM facts
  UNION ALL SELECT code, period_end, unnest(['operating_profit_margin', 'liability_to_assets']), false FROM facts)
SELECT metric_name, CAST(period_end AS VARCHAR) AS period_end, count(DISTINCT code) AS security_count, count(*) AS record_count,
  count(*) FILTER (WHERE ok) AS calculated_count, count(*) FILTER (WHERE NOT ok) AS unavailable_count FROM s GROUP BY 1, 2""",
)
def metric_coverage(spark: SparkSession, folder: str) -> DataFrame:
    facts = d.part_facts(table(spark, folder, "lineitem"))
    covered = m.metric_coverage(m.ratio_metrics(facts))
    return covered.withColumn("period_end", iso_text(F.col("period_end")))


def quarter_end(day: F.Column) -> F.Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


SQL_QUARTER = "last_day((date_trunc('quarter', {c}) + INTERVAL 2 MONTH)::DATE)"


@register(
    "yoy_growth",
    f"""WITH q AS (SELECT c_mktsegment AS segment, {SQL_QUARTER.format(c='o_orderdate')} AS period_end,
  sum(round(o_totalprice * 100)::BIGINT)::DOUBLE AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT a.segment, CAST(a.period_end AS VARCHAR) AS period_end, round(a.revenue / b.revenue - 1, 6) AS growth,
  CASE WHEN b.revenue IS NULL THEN 'missing_prior_inputs' WHEN b.revenue = 0 THEN 'zero_denominator' ELSE 'calculated' END AS status
FROM q a LEFT JOIN q b ON a.segment = b.segment AND b.period_end = (a.period_end - INTERVAL 1 YEAR)::DATE""",
)
def yoy_growth(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    per_customer = orders.groupBy("o_custkey", quarter_end(F.to_date("o_orderdate")).alias("period_end")).agg(
        F.sum(d.cents(F.col("o_totalprice"))).alias("cents")
    )
    quarterly = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), "period_end")
        .agg(F.sum("cents").cast("double").alias("revenue"))
    )
    aligned = m.align_periods(quarterly, ["segment"], "period_end", current=["revenue"], prior=["revenue"])
    value, status = m.growth(F.col("current.revenue"), F.col("prior.revenue"))
    return aligned.select(
        "segment", iso_text(F.col("period_end")).alias("period_end"), F.round(value, 6).alias("growth"), status.alias("status")
    )


@register(
    "avg_balance_ratio",
    f"""WITH q AS (SELECT c_nationkey AS nation, {SQL_QUARTER.format(c='o_orderdate')} AS period_end,
  sum(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100)::BIGINT END)::DOUBLE AS income, sum(round(o_totalprice * 100)::BIGINT)::DOUBLE AS equity
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT a.nation, CAST(a.period_end AS VARCHAR) AS period_end,
  round(a.income / nullif((a.equity + b.equity) / 2, 0), 6) AS ratio,
  CASE WHEN a.income IS NULL OR a.equity IS NULL THEN 'missing_current_inputs' WHEN b.equity IS NULL THEN 'missing_opening_inputs'
       WHEN (a.equity + b.equity) / 2 = 0 THEN 'zero_denominator' ELSE 'calculated' END AS status
FROM q a LEFT JOIN q b ON a.nation = b.nation AND b.period_end = make_date(year(a.period_end)::INT - 1, 12, 31)""",
)
def avg_balance_ratio(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    amount = d.cents(F.col("o_totalprice"))
    per_customer = orders.groupBy("o_custkey", quarter_end(F.to_date("o_orderdate")).alias("period_end")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", amount)).alias("income"), F.sum(amount).alias("equity")
    )
    quarterly = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), "period_end")
        .agg(F.sum("income").cast("double").alias("income"), F.sum("equity").cast("double").alias("equity"))
    )
    aligned = m.align_periods(quarterly, ["nation"], "period_end", current=["income", "equity"], opening=["equity"])
    value, status = m.average_ratio(F.col("current.income"), F.col("current.equity"), F.col("opening.equity"))
    return aligned.select(
        "nation", iso_text(F.col("period_end")).alias("period_end"), F.round(value, 6).alias("ratio"), status.alias("status")
    )


_FLAGS = {"revenue": "true", "net_income_parent": "l_discount > 0.02", "equity_parent": "l_returnflag <> 'R'", "operating_profit": "l_linestatus = 'F'",
          "income_tax_expense": "l_tax > 0.04", "total_profit": "l_linestatus = 'O'", "net_cash_flow_operating": "l_quantity > 25",
          "capital_expenditure_cash": "l_quantity <= 10", "total_equity": "l_returnflag = 'A'", "monetary_funds": "l_linenumber = 1",
          "short_term_borrowings": "l_linenumber >= 2", "non_current_liabilities_due_within_one_year": "l_linenumber <= 3",
          "long_term_borrowings": "l_linenumber <= 5", "bonds_payable": "l_linenumber >= 3"}


def supplier_facts(lineitem: DataFrame) -> DataFrame:
    """Quarterly facts of each supplier; a field without rows is missing in the source."""
    amount = d.cents(F.col("l_extendedprice"))
    grouped = lineitem.groupBy(
        F.col("l_suppkey").cast("string").alias("security_code"), quarter_end(F.to_date("l_shipdate")).alias("period_end")
    ).agg(
        *[F.sum(F.when(F.expr(c), amount)).cast("double").alias(f) for f, c in _FLAGS.items()],
        F.max(F.to_date("l_shipdate")).alias("fetched_at"),
    )
    return grouped.select(
        "security_code", F.col("security_code").alias("security_name"), "period_end", F.lit("Q").alias("report_type"),
        F.col("fetched_at").alias("filing_date"), F.col("fetched_at").alias("available_from"), "fetched_at",
        F.lit("r").alias("raw_record_id"),
        *[d.fetched_fact(f, "s") for f in _FLAGS],
    )


_SQL_SUPPLIER = (
    f"WITH f AS (SELECT l_suppkey::VARCHAR AS code, {SQL_QUARTER.format(c='l_shipdate')} AS pe, max(l_shipdate::DATE) AS av, "
    + ", ".join(f"sum(CASE WHEN {c} THEN round(l_extendedprice * 100)::BIGINT END)::DOUBLE AS {f}" for f, c in _FLAGS.items())
    + " FROM lineitem GROUP BY 1, 2), g AS (SELECT *, total_equity + (short_term_borrowings + non_current_liabilities_due_within_one_year"
    " + long_term_borrowings + bonds_payable) - monetary_funds AS ic FROM f)"
)


@register(
    "advanced_metrics",
    _SQL_SUPPLIER
    + """, j AS (SELECT a.*, p.revenue AS p_rev, p.net_income_parent AS p_ni, o.equity_parent AS o_eq, o.ic AS o_ic, p.av AS p_av, o.av AS o_av
  FROM g a LEFT JOIN g p ON p.code = a.code AND p.pe = (a.pe - INTERVAL 1 YEAR)::DATE
           LEFT JOIN g o ON o.code = a.code AND o.pe = make_date(year(a.pe)::INT - 1, 12, 31)),
u AS (
 SELECT code, pe, 'revenue_growth_yoy' AS metric_name, round(revenue / nullif(p_rev, 0) - 1, 6) AS value,
   CASE WHEN revenue IS NULL THEN 'missing_current_inputs' WHEN p_rev IS NULL THEN 'missing_prior_inputs' WHEN p_rev = 0 THEN 'zero_denominator' ELSE 'calculated' END AS st, greatest(av, p_av) AS af FROM j
 UNION ALL SELECT code, pe, 'net_income_growth_yoy', round(net_income_parent / nullif(p_ni, 0) - 1, 6),
   CASE WHEN net_income_parent IS NULL THEN 'missing_current_inputs' WHEN p_ni IS NULL THEN 'missing_prior_inputs' WHEN p_ni = 0 THEN 'zero_denominator' ELSE 'calculated' END, greatest(av, p_av) FROM j
 UNION ALL SELECT code, pe, 'roe_parent_average', round(net_income_parent / nullif((equity_parent + o_eq) / 2, 0), 6),
   CASE WHEN net_income_parent IS NULL OR equity_parent IS NULL THEN 'missing_current_inputs' WHEN o_eq IS NULL THEN 'missing_opening_inputs' WHEN (equity_parent + o_eq) / 2 = 0 THEN 'zero_denominator' ELSE 'calculated' END, greatest(av, o_av) FROM j
 UNION ALL SELECT code, pe, 'roic_average', round(operating_profit * (1 - income_tax_expense / nullif(total_profit, 0)) / nullif((ic + o_ic) / 2, 0), 6),
   CASE WHEN operating_profit IS NULL OR income_tax_expense IS NULL OR total_profit IS NULL OR ic IS NULL THEN 'missing_current_inputs' WHEN o_ic IS NULL THEN 'missing_opening_inputs'
        WHEN total_profit = 0 THEN 'zero_tax_rate_denominator' WHEN (ic + o_ic) / 2 = 0 THEN 'zero_denominator' ELSE 'calculated' END, greatest(av, o_av) FROM j
 UNION ALL SELECT code, pe, 'free_cash_flow', net_cash_flow_operating - capital_expenditure_cash,
   CASE WHEN net_cash_flow_operating IS NULL OR capital_expenditure_cash IS NULL THEN 'missing_current_inputs' ELSE 'calculated' END, av FROM j)
SELECT code AS security_code, CAST(pe AS VARCHAR) AS period_end, metric_name, CASE WHEN st = 'calculated' THEN value END AS value, st AS calculation_status, CAST(af AS VARCHAR) AS available_from FROM u""",
)
def advanced_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = m.advanced_metrics(supplier_facts(table(spark, folder, "lineitem")), fixed.ADVANCED_METRIC_DEFINITION_VERSION)
    return rows.select(
        "security_code", iso_text(F.col("period_end")).alias("period_end"), "metric_name", F.round("value", 6).alias("value"),
        "calculation_status", iso_text(F.col("available_from")).alias("available_from"),
    )


# --- point in time ------------------------------------------------------------------
_AS_OF = "1999-06-30"


@register(
    "pit_gate_default",
    f"""SELECT l_partkey, CAST(l_shipdate::DATE AS VARCHAR) AS available_from, l_shipdate::DATE <= DATE '{_AS_OF}' AS available
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_shipdate DESC) = 1""",
)
def pit_gate_default(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", F.to_date("l_shipdate").alias("available_from"))
    gated = latest_then_gate(rows, ["l_partkey"], ["l_orderkey"], "available_from", F.lit(_AS_OF).cast("date"))
    return gated.select("l_partkey", iso_text(F.col("available_from")).alias("available_from"), "available")


@register(
    "pit_gate_asof",
    f"""SELECT l_partkey, l_orderkey, CAST(l_shipdate::DATE AS VARCHAR) AS available_from FROM lineitem WHERE l_shipdate::DATE <= DATE '{_AS_OF}'
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_shipdate DESC) = 1""",
)
def pit_gate_asof(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", F.to_date("l_shipdate").alias("available_from"))
    known = latest_known(rows, ["l_partkey"], ["l_orderkey"], "available_from", F.lit(_AS_OF).cast("date"))
    return known.select("l_partkey", "l_orderkey", iso_text(F.col("available_from")).alias("available_from"))


@register(
    "pit_per_security",
    """WITH held AS (SELECT l_suppkey, year(l_shipdate)::INT AS y, max(l_shipdate::DATE) AS av, sum(round(l_quantity)::BIGINT)::BIGINT AS qty FROM lineitem GROUP BY 1, 2)
SELECT s_suppkey, CAST(av AS VARCHAR) AS available_from, y AS fact_year, qty FROM supplier JOIN held ON l_suppkey = s_suppkey
WHERE av <= (DATE '1996-12-31' + (s_suppkey % 5)::INT * INTERVAL 1 YEAR)::DATE
QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY y DESC) = 1""",
)
def pit_per_security(spark: SparkSession, folder: str) -> DataFrame:
    """As-of selection where every security has its own date."""
    held = table(spark, folder, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("fact_year")).agg(
        F.max(F.to_date("l_shipdate")).alias("available_from"), F.sum(F.round("l_quantity").cast("long")).alias("qty")
    )
    supplier = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.add_months(F.lit("1996-12-31").cast("date"), (F.col("s_suppkey") % 5).cast("int") * 12).alias("as_of"),
    )
    rows = supplier.join(held, F.col("s_suppkey") == F.col("l_suppkey"))
    known = latest_known(rows.drop("l_suppkey"), ["s_suppkey"], ["fact_year"], "available_from", F.col("as_of"))
    return known.select("s_suppkey", iso_text(F.col("available_from")).alias("available_from"), "fact_year", "qty")
