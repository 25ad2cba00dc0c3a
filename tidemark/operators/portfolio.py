"""Portfolio valuation, weights and review categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import WEIGHT_TOLERANCE
from tidemark.functions.coerce import currency, listed_code
from tidemark.operators.joins import join_checked


def weights(holdings: DataFrame, value: str = "market_value", day: str = "as_of_date") -> DataFrame:
    """Each position's share of its day's total; summed as decimals, so in any order."""
    holdings = holdings.withColumn(value, F.col(value).cast("decimal(28,2)"))
    totals = holdings.groupBy(day).agg(F.sum(value).alias("total_value"))
    joined = join_checked(holdings, totals, [day], "left")
    return joined.withColumn(
        "actual_weight", F.when(F.col("total_value") > 0, F.col(value).cast("double") / F.col("total_value").cast("double"))
    )


def review_category(weight: Column, target: Column, tolerance: float = WEIGHT_TOLERANCE) -> tuple[Column, Column]:
    """(category, reason) in fixed precedence, over columns of the card.

    Expects thesis_status, valuation_status, risk_status and carded (true when a card exists).
    """
    thesis, value, risk = F.col("thesis_status"), F.col("valuation_status"), F.col("risk_status")
    cases = [
        (F.col("carded").isNull(), "REVIEW", "missing_investment_card"),
        (thesis == "broken", "EXIT_candidate", "thesis_status_broken"),
        (risk == "material", "TRIM_candidate", "risk_status_material"),
        (
            (thesis == "intact") & (value == "attractive") & (weight < target - tolerance),
            "ADD_candidate",
            "intact_attractive_below_target",
        ),
        ((value == "expensive") & (weight > target + tolerance), "TRIM_candidate", "expensive_above_target"),
        (
            (thesis == "intact") & (risk == "stable") & value.isin("attractive", "fair"),
            "HOLD",
            "intact_stable",
        ),
    ]
    category, reason = F.lit("REVIEW"), F.lit("manual_judgment_required")
    for condition, name, why in reversed(cases):
        category = F.when(condition, F.lit(name)).otherwise(category)
        reason = F.when(condition, F.lit(why)).otherwise(reason)
    return category, reason


def portfolio_review(holdings: DataFrame, cards: DataFrame, tolerance: float = WEIGHT_TOLERANCE) -> DataFrame:
    """Review category of every holding from its card and its weight."""
    card = cards.select(
        "security_code", "thesis_status", "valuation_status", "risk_status",
        F.col("target_weight").alias("card_weight"), "updated_at", F.lit(True).alias("carded"),
    )
    joined = weights(holdings).join(card, "security_code", "left")
    category, reason = review_category(F.col("actual_weight"), F.col("card_weight"), tolerance)
    return joined.select(
        "security_code",
        F.nullif(F.col("security_name"), F.lit("")).alias("security_name"),
        "as_of_date",
        F.round("actual_weight", 12).alias("actual_weight"),
        F.col("card_weight").alias("target_weight"),
        category.alias("category"),
        F.array(reason).alias("reasons"),
        F.col("updated_at").alias("investment_card_updated_at"),
    )


def value_positions(holdings: DataFrame, quotes: DataFrame) -> DataFrame:
    """Holdings with cost, newest quote, market value and whether a quote exists.

    A position already quoted keeps its price unless the quote is newer.
    """
    held = holdings.withColumn("security_code", listed_code(F.col("security_code")))
    for name, kind in (("latest_price", "double"), ("quote_date", "string"), ("quote_source", "string")):
        if name not in held.columns:
            held = held.withColumn(name, F.lit(None).cast(kind))
    fresh = quotes.select(
        "security_code", F.col("close").alias("__price"), F.col("trade_date").alias("__date"), F.col("source").alias("__source")
    )
    joined = held.join(fresh, "security_code", "left")
    newer = F.col("__price").isNotNull() & F.coalesce(F.col("__date") > F.col("quote_date"), F.lit(True))
    for name, replacement in (("latest_price", "__price"), ("quote_date", "__date"), ("quote_source", "__source")):
        joined = joined.withColumn(f"__new_{name}", F.when(newer, F.col(replacement)).otherwise(F.col(name)))
    return joined.select(
        "as_of_date",
        "security_code",
        "security_name",
        "quantity",
        "average_cost",
        "currency",
        currency(F.col("quantity") * F.col("average_cost")).alias("cost_basis"),
        "target_weight",
        F.col("__new_latest_price").alias("latest_price"),
        F.col("__new_quote_date").alias("quote_date"),
        F.col("__new_quote_source").alias("quote_source"),
        currency(F.col("quantity") * F.col("__new_latest_price")).alias("market_value"),
        F.when(F.col("__new_latest_price").isNotNull(), F.lit("available")).otherwise(F.lit("missing")).alias("quote_status"),
    )


def valuation_summary(positions: DataFrame) -> DataFrame:
    """Positions, cost, covered value and quote coverage per day."""
    money = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(28,2)")).cast("double")
    return positions.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("position_count"),
        money("cost_basis").alias("cost_basis"),
        money("market_value").alias("covered_value"),
        F.count_if(F.col("quote_status") == "available").alias("quotes_available"),
    )


def owner_log(log: DataFrame, owner: str, when: str = "decided_at", key: str = "id") -> DataFrame:
    """One owner's decisions, newest first."""
    return log.where(F.col("owner") == owner).orderBy(F.col(when).desc(), F.col(key).desc())
