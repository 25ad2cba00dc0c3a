"""Universe filters, eligibility with reasons, and the composite percentile screen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.coerce import exchange_suffix, finite
from tidemark.operators.ordering import ranked
from tidemark.operators.versions import latest_by


@dataclass(frozen=True)
class Universe:
    pattern: str = fixed.LISTED_CODE_PATTERN
    exchanges: Sequence[str] = tuple(fixed.STOCK_EXCHANGES)
    prefixes: Sequence[str] = tuple(fixed.EXCLUDED_PREFIXES)
    boards: Sequence[str] = tuple(fixed.EXCLUDED_BOARDS)
    statuses: Sequence[str] = tuple(fixed.STOCK_STATUSES)

    def code_allowed(self, code: Column) -> Column:
        allowed = code.rlike(self.pattern) & exchange_suffix(code).isin(*self.exchanges)
        if self.prefixes:
            allowed = allowed & ~code.rlike("^(" + "|".join(self.prefixes) + ")")
        return F.coalesce(allowed, F.lit(False))

    def record_allowed(self, code: Column, memberships: Column, status: Column) -> Column:
        """Code rule, board exclusion and status list; a missing board list or status passes."""
        excluded = F.coalesce(
            F.arrays_overlap(memberships, F.array(*[F.lit(b) for b in self.boards])), F.lit(False)
        )
        return self.code_allowed(code) & ~excluded & (status.isNull() | status.isin(*self.statuses))


@dataclass(frozen=True)
class ScreenRules:
    required: Sequence[str] = tuple(fixed.REQUIRED_METRICS)
    components: Sequence[tuple[str, str, float]] = tuple(fixed.SCREEN_COMPONENTS)
    tiers: Sequence[tuple[str, float]] = tuple(fixed.TIER_CUTS)
    last_tier: str = fixed.LAST_TIER
    universe: Universe = field(default_factory=Universe)


def reasons(*conditions: tuple[Column, str]) -> Column:
    """Sorted, distinct names of the conditions that hold."""
    marks = [F.when(condition, F.lit(name)) for condition, name in conditions]
    return F.sort_array(F.array_distinct(F.array_compact(F.array(*marks))))


def tier(rank: Column, size: Column, tiers: Sequence[tuple[str, float]], last: str) -> Column:
    """Tier by the share of rows ranked at or below this one."""
    share = (size - rank + 1).cast("double") / size.cast("double")
    out = F.lit(last)
    for name, cut in reversed(list(tiers)):
        out = F.when(share >= F.lit(cut), F.lit(name)).otherwise(out)
    return out


def latest_metrics_wide(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per security the newest row of each named metric, one column per metric.

    The version choice is part of the aggregation: one shuffle on the security.
    """
    newest = F.struct(
        F.col("period_end"),
        F.col("fetched_at"),
        F.col("calculation_status"),
        finite(F.col("value")).alias("value"),
        F.col("available_from"),
        F.col("security_name"),
    )
    return metrics.groupBy("security_code").agg(
        *[F.max(F.when(F.col("metric_name") == n, newest)).alias(n) for n in names]
    )


def eligibility(master: DataFrame, valuations: DataFrame, metrics: DataFrame, rules: ScreenRules) -> DataFrame:
    """Candidates with their values and the sorted reasons that exclude them.

    The newest metric is chosen first and then gated on availability; a metric not yet
    known on the valuation date excludes the security instead of falling back.
    """
    universe = rules.universe
    allowed = (
        latest_by(
            master.select("security_code", "observed_date", "fetched_at", "market_memberships", "listing_status"),
            ["security_code"],
            ["observed_date", "fetched_at"],
        )
        .where(universe.record_allowed(F.col("security_code"), F.col("market_memberships"), F.col("listing_status")))
        .select("security_code")
    )
    value = latest_by(
        valuations.select("security_code", "as_of_date", "fetched_at", "pe_ttm", "market_cap"),
        ["security_code"],
        ["as_of_date", "fetched_at"],
    ).select(
        "security_code",
        "as_of_date",
        finite(F.col("pe_ttm")).alias("pe_ttm"),
        finite(F.col("market_cap")).alias("market_cap"),
        F.lit(True).alias("valued"),
    )
    wide = latest_metrics_wide(metrics, rules.required)
    rows = value.join(wide, "security_code", "full").join(allowed, "security_code", "left_semi")
    conditions = [
        (F.col("valued").isNull(), "missing_valuation"),
        (F.col("pe_ttm").isNull(), "missing_pe_ttm"),
        (F.col("pe_ttm") <= 0, "non_positive_pe_ttm"),
        (F.col("market_cap").isNull(), "missing_market_cap"),
        (F.col("market_cap") <= 0, "non_positive_market_cap"),
    ]
    usable = {}
    for name in rules.required:
        metric = F.col(name)
        missing = F.coalesce(metric["calculation_status"] != "calculated", F.lit(True)) | metric["value"].isNull()
        early = ~missing & F.coalesce(metric["available_from"] > F.col("as_of_date"), F.lit(False))
        conditions += [(missing, f"missing_metric:{name}"), (early, f"not_available_at_screen_date:{name}")]
        usable[name] = ~missing & ~early
    rows = rows.withColumn("eligibility_reasons", reasons(*conditions))
    picked = {n: F.when(usable[n], F.col(n)) for n in rules.required}
    first_name = F.coalesce(*[picked[n]["security_name"] for n in rules.required])
    latest = {
        c: F.greatest(*[picked[n][c] for n in rules.required]) if len(picked) > 1 else picked[rules.required[0]][c]
        for c in ("period_end", "available_from")
    }
    return rows.select(
        "security_code",
        first_name.alias("security_name"),
        "as_of_date",
        latest["period_end"].alias("financial_period_end"),
        latest["available_from"].alias("financial_available_from"),
        "pe_ttm",
        "market_cap",
        *[picked[n]["value"].alias(n) for n in rules.required],
        "eligibility_reasons",
        (F.size("eligibility_reasons") == 0).alias("eligible"),
    )


def composite_scores(candidates: DataFrame, rules: ScreenRules, key: str = "security_code") -> DataFrame:
    """Score, rank and tier of the eligible rows.

    All components are ranked in one pass: the rows are unpivoted to (component, value,
    key), ranked per component over range partitions, and combined per key again.
    """
    eligible = candidates.where(F.col("eligible")).select(key, *[c for c, _, _ in rules.components])
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("component"), F.col(c).cast("double").alias("component_value"))
            for i, (c, _, _) in enumerate(rules.components)
        ]
    )
    long = eligible.select(key, F.inline(entries))
    placed = ranked(long, [F.col("component_value").asc(), F.col(key).asc()], by=["component"], rank="place", size="n")
    position = (F.col("place") - 1).cast("double") / F.nullif(F.col("n") - 1, F.lit(0)).cast("double")
    lower = [i for i, (_, direction, _) in enumerate(rules.components) if direction == "lower"]
    directed = F.when(F.col("component").isin(*lower), F.lit(1.0) - position).otherwise(position) if lower else position
    part = F.round(F.when(F.col("n") == 1, F.lit(1.0)).otherwise(directed), 12)
    scored = placed.groupBy(key).agg(
        *[F.max(F.when(F.col("component") == i, part)).alias(f"part_{c}") for i, (c, _, _) in enumerate(rules.components)]
    )
    total = F.lit(0.0)
    for name, _, weight in rules.components:
        total = total + F.col(f"part_{name}") * F.lit(weight)
    scored = scored.withColumn("score", F.round(total, 12))
    out = ranked(scored, [F.col("score").desc(), F.col(key).asc()], rank="rank", size="n")
    components = F.create_map(*[x for c, _, _ in rules.components for x in (F.lit(c), F.col(f"part_{c}"))])
    return out.select(
        key,
        "score",
        components.alias("score_components"),
        "rank",
        tier(F.col("rank"), F.col("n"), rules.tiers, rules.last_tier).alias("priority"),
    )


def composite_screen(
    master: DataFrame, valuations: DataFrame, metrics: DataFrame, rules: ScreenRules | None = None
) -> DataFrame:
    """The screen: every candidate with score, rank and tier, or its exclusion reasons."""
    from tidemark.session import settle

    rules = rules or ScreenRules()
    candidates = settle(eligibility(master, valuations, metrics, rules))
    scored = composite_scores(candidates, rules)
    return candidates.join(scored, "security_code", "left").withColumn(
        "priority", F.coalesce(F.col("priority"), F.lit(fixed.REJECT_TIER))
    )


def queue_order(screen: DataFrame) -> DataFrame:
    return screen.orderBy(F.col("rank").asc_nulls_last(), F.col("security_code").asc())


def priority_counts(screen: DataFrame) -> DataFrame:
    """Rows per tier with their share of the whole queue."""
    counts = screen.groupBy("priority").agg(F.count(F.lit(1)).alias("record_count"))
    total = counts.agg(F.sum("record_count").alias("total")).scalar()
    return counts.withColumn("percent", F.col("record_count") / total * 100)


def screen_coverage(screen: DataFrame) -> DataFrame:
    return screen.agg(
        F.count(F.lit(1)).alias("universe_count"),
        F.count_if(F.col("eligible")).alias("eligible_count"),
        F.count_if(~F.col("eligible")).alias("reject_count"),
    )


def dashboard_filter(
    screen: DataFrame,
    query: str = "",
    priority: str = "all",
    eligible: bool | None = None,
    min_score: float = 0.0,
    band: str = "all",
) -> DataFrame:
    """Interactive filter of the queue; a row without a score passes a minimum of zero."""
    from tidemark.functions.coerce import cap_band

    condition = F.lit(True)
    text = query.strip().lower()
    if text:
        condition = condition & (
            F.lower("security_code").contains(text) | F.lower(F.coalesce(F.col("security_name"), F.lit(""))).contains(text)
        )
    if priority != "all":
        condition = condition & (F.col("priority") == priority)
    if eligible is not None:
        condition = condition & (F.col("eligible") == eligible)
    if min_score > 0:
        condition = condition & (F.coalesce(F.col("score"), F.lit(0.0)) * 100 >= min_score)
    if band != "all":
        condition = condition & (cap_band(F.col("market_cap")) == band)
    return screen.where(condition)


_SORTS = {
    "score": lambda: F.col("score").desc_nulls_last(),
    "pe": lambda: F.col("pe_ttm").asc_nulls_last(),
    "marketCap": lambda: F.col("market_cap").desc_nulls_last(),
    "margin": lambda: F.col("net_profit_margin").desc_nulls_last(),
    "rank": lambda: F.col("rank").asc_nulls_last(),
}


def page(df: DataFrame, sort: str, number: int, size: int, key: str = "security_code") -> DataFrame:
    """One page of a sorted view. The key ends the order, so pages never overlap."""
    return df.orderBy(_SORTS[sort](), F.col(key).asc()).offset((number - 1) * size).limit(size)
