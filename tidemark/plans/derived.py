"""Securities, valuations and facts derived from the given star-schema tables.

Amounts are whole cents, so sums are exact whatever order the tasks add them in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.screening import ScreenRules, Universe

SCREEN_UNIVERSE = Universe(
    pattern=r"^\d+\.(SH|SZ|BJ)$", exchanges=("SH", "SZ"), prefixes=("300", "688"), boards=("PROMO",), statuses=("listed",)
)
SCREEN_RULES = ScreenRules(universe=SCREEN_UNIVERSE)


def part_code(key: Column) -> Column:
    suffix = F.when(key % 4 == 0, F.lit("BJ")).when(key % 4 == 2, F.lit("SZ")).otherwise(F.lit("SH"))
    return F.concat_ws(".", key.cast("string"), suffix)


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def security_master(part: DataFrame) -> DataFrame:
    phase = F.col("p_size") % 10
    return part.select(
        part_code(F.col("p_partkey")).alias("security_code"),
        F.lit("2001-12-31").cast("date").alias("observed_date"),
        F.col("p_partkey").alias("fetched_at"),
        F.array("p_type", "p_brand").alias("market_memberships"),
        F.when(phase == 0, F.lit(None).cast("string")).when(phase == 1, F.lit("suspended")).otherwise(F.lit("listed")).alias("listing_status"),
        F.col("p_name").alias("security_name"),
    )


def valuations(lineitem: DataFrame) -> DataFrame:
    """Every line is a valuation snapshot of its part; many are re-fetches of a day."""
    return lineitem.select(
        part_code(F.col("l_partkey")).alias("security_code"),
        F.to_date("l_shipdate").alias("as_of_date"),
        F.col("l_orderkey").alias("fetched_at"),
        F.when(F.col("l_tax") > 0, (F.col("l_quantity") - 3) * 1.5).alias("pe_ttm"),
        cents(F.col("l_extendedprice")).cast("double").alias("market_cap"),
    )


def fetched_fact(field: str, statement: str) -> Column:
    """A column of amounts as the fact of a fetch; a null amount is missing in the source."""
    return F.struct(
        F.lit(statement).alias("statement_type"),
        F.col(field).alias("value"),
        F.when(F.col(field).isNull(), F.lit("missing_in_source")).otherwise(F.lit("present")).alias("value_status"),
    ).alias(field)


def part_facts(lineitem: DataFrame) -> DataFrame:
    """Yearly facts of each part, one fetch and one row per return flag."""
    price = cents(F.col("l_extendedprice"))
    discount, tax = cents(F.col("l_discount")), cents(F.col("l_tax"))
    # Grouped by plain numbers; codes and dates are made of the groups.
    grouped = lineitem.groupBy(
        F.col("l_partkey").alias("part"), F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("raw_record_id")
    ).agg(
        F.sum(price).cast("double").alias("revenue"),
        F.sum(price * (discount - tax)).cast("double").alias("net_income_parent"),
        F.sum(F.when(F.col("l_linestatus") == "F", price * (6 - tax))).cast("double").alias("net_cash_flow_operating"),
        F.max(F.to_date("l_shipdate")).alias("fetched_at"),
    )
    lag = F.when(F.col("raw_record_id") == "R", 30).otherwise(0)
    fields = ["revenue", "net_income_parent", "net_cash_flow_operating"]
    grouped = grouped.withColumns(
        {"security_code": part_code(F.col("part")), "period_end": F.make_date("year", F.lit(12), F.lit(31))}
    )
    statement = lambda f: "cash_flow_statement" if f.startswith("net_cash") else "income_statement"
    return grouped.select(
        "security_code",
        F.col("security_code").alias("security_name"),
        "period_end",
        F.concat(F.year("period_end").cast("string"), F.lit("FY")).alias("report_type"),
        F.date_add("fetched_at", lag).alias("filing_date"),
        F.date_add("fetched_at", lag).alias("available_from"),
        "fetched_at",
        "raw_record_id",
        *[fetched_fact(f, statement(f)) for f in fields],
    )


SQL_CODE = "concat({k}, '.', CASE WHEN {k} % 4 = 0 THEN 'BJ' WHEN {k} % 4 = 2 THEN 'SZ' ELSE 'SH' END)"

SQL_FACTS = f"""
raw_facts AS (
  SELECT {SQL_CODE.format(k='l_partkey')} AS code, make_date(year(l_shipdate)::INT, 12, 31) AS period_end,
         l_returnflag AS rec, max(l_shipdate::DATE) AS fetched,
         sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE AS revenue,
         sum(round(l_extendedprice * 100)::BIGINT * (round(l_discount * 100)::BIGINT - round(l_tax * 100)::BIGINT))::DOUBLE AS net_income,
         sum(CASE WHEN l_linestatus = 'F' THEN round(l_extendedprice * 100)::BIGINT * (6 - round(l_tax * 100)::BIGINT) END)::DOUBLE AS cash
  FROM lineitem GROUP BY 1, 2, 3),
facts AS (
  SELECT *, (fetched + CASE WHEN rec = 'R' THEN 30 ELSE 0 END * INTERVAL 1 DAY)::DATE AS available
  FROM raw_facts QUALIFY row_number() OVER (PARTITION BY code, period_end ORDER BY fetched DESC, rec DESC) = 1)
"""

SQL_SCREEN = f"""
WITH {SQL_FACTS},
metrics AS (
  SELECT code, period_end, available, fetched,
    CASE WHEN revenue = 0 THEN NULL ELSE round(net_income / revenue, 12) END AS npm,
    CASE WHEN cash IS NULL OR revenue = 0 THEN NULL ELSE round(cash / revenue, 12) END AS ocfm
  FROM facts QUALIFY row_number() OVER (PARTITION BY code ORDER BY period_end DESC, fetched DESC) = 1),
allowed AS (
  SELECT {SQL_CODE.format(k='p_partkey')} AS code FROM part
  WHERE p_partkey % 4 <> 0 AND NOT regexp_matches(p_partkey::VARCHAR, '^(300|688)') AND p_type <> 'PROMO' AND p_size % 10 <> 1),
vals AS (
  SELECT {SQL_CODE.format(k='l_partkey')} AS code, l_shipdate::DATE AS as_of,
    CASE WHEN l_tax > 0 THEN (l_quantity - 3) * 1.5 END AS pe, round(l_extendedprice * 100)::BIGINT::DOUBLE AS cap
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate::DATE DESC, l_orderkey DESC, pe DESC NULLS LAST, cap DESC) = 1),
joined AS (
  SELECT coalesce(v.code, m.code) AS code, v.code IS NULL AS no_value, v.as_of, v.pe, v.cap, m.* EXCLUDE (code),
    npm IS NULL AS npm_missing, ocfm IS NULL AS ocfm_missing, coalesce(m.available > v.as_of, false) AS early
  FROM vals v FULL JOIN metrics m ON v.code = m.code WHERE coalesce(v.code, m.code) IN (SELECT code FROM allowed)),
cand AS (
  SELECT *, concat_ws(',',
    CASE WHEN cap IS NULL THEN 'missing_market_cap' END,
    CASE WHEN npm_missing THEN 'missing_metric:net_profit_margin' END,
    CASE WHEN ocfm_missing THEN 'missing_metric:operating_cash_flow_margin' END,
    CASE WHEN pe IS NULL THEN 'missing_pe_ttm' END,
    CASE WHEN no_value THEN 'missing_valuation' END,
    CASE WHEN cap <= 0 THEN 'non_positive_market_cap' END,
    CASE WHEN pe <= 0 THEN 'non_positive_pe_ttm' END,
    CASE WHEN NOT npm_missing AND early THEN 'not_available_at_screen_date:net_profit_margin' END,
    CASE WHEN NOT ocfm_missing AND early THEN 'not_available_at_screen_date:operating_cash_flow_margin' END) AS reasons
  FROM joined),
scored AS (
  SELECT code,
    round((row_number() OVER (ORDER BY npm, code) - 1) / (count(*) OVER () - 1)::DOUBLE, 12) AS p1,
    round((row_number() OVER (ORDER BY ocfm, code) - 1) / (count(*) OVER () - 1)::DOUBLE, 12) AS p2,
    round(1 - (row_number() OVER (ORDER BY pe, code) - 1) / (count(*) OVER () - 1)::DOUBLE, 12) AS p3,
    round((row_number() OVER (ORDER BY cap, code) - 1) / (count(*) OVER () - 1)::DOUBLE, 12) AS p4
  FROM cand WHERE reasons = ''),
totals AS (SELECT code, round(p1 * 0.30 + p2 * 0.30 + p3 * 0.25 + p4 * 0.15, 12) AS score FROM scored),
places AS (SELECT code, score, row_number() OVER (ORDER BY score DESC, code) AS rank, count(*) OVER () AS n FROM totals)
"""
