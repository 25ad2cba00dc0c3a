"""Metrics over long facts: configured ratios, growth, returns and cash flow.

Facts are long rows (one per security, period, field and fetch) or rows of whole fetches. The version choice and
the pivot happen in one aggregation on (security, period): each needed field keeps the
newest fetch as it is combined, so facts are shuffled once, after map-side combining.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.fixed_values import DEBT_ITEMS, METRIC_DEFINITION_VERSION, RATIO_METRICS
from tidemark.functions.coerce import finite
from tidemark.functions.names import is_period_end

KEYS = ["security_code", "period_end"]
CALCULATED = "calculated"


def _held_fields(facts: DataFrame) -> list[str]:
    """The columns of a table of fetches that are facts: structs with a value status."""
    structs = [f for f in facts.schema.fields if isinstance(f.dataType, StructType)]
    return [f.name for f in structs if "value_status" in f.dataType.names]


def latest_wide(facts: DataFrame, fields: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (security, period): per field its newest fact, plus an identity struct.

    ``facts`` are long rows, one per fact, or one row per fetch of a report. A fetch has a column
    per field, a struct (statement_type, value, value_status), null where it has no such fact; such rows are sorted
    and combined as they are, and never opened into one row per fact.

    A field column is null when no fact exists, and has a null ``value`` when the newest
    fact is missing in the source. The identity comes from the newest fetch of the
    report, with the smallest (statement, field) as tie-break.
    """
    newest = F.struct("fetched_at", "raw_record_id")
    if "canonical_field_name" in facts.columns:
        found = {f: (F.col("canonical_field_name") == f, F.col("value"), F.col("value_status")) for f in fields}
        place = [F.col("statement_type"), F.col("canonical_field_name")]
    else:
        held = _held_fields(facts)
        found = {f: (F.col(f).isNotNull(), F.col(f)["value"], F.col(f)["value_status"]) for f in held}
        none = (F.lit(False), F.lit(None).cast("double"), F.lit(None).cast("string"))
        found = {f: found.get(f, none) for f in fields}
        marks = [F.when(F.col(f).isNotNull(), F.struct(F.col(f)["statement_type"], F.lit(f))) for f in held]
        place = [F.greatest(*marks) if len(marks) > 1 else marks[0]]
        facts = facts.where(reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in held]))
    per_field = [
        F.max(
            F.when(
                there,
                F.struct(
                    F.col("fetched_at"),
                    F.col("raw_record_id"),
                    F.when(status == "present", finite(value)).alias("value"),
                    status.alias("value_status"),
                    F.col("available_from"),
                ),
            )
        ).alias(f)
        for f, (there, value, status) in found.items()
    ]
    identity = F.struct("security_name", "report_type", "filing_date", "available_from", "fetched_at")
    return facts.groupBy(*keys).agg(*per_field, F.max_by(identity, F.struct(newest, *place)).alias("identity"))


def ratio_value(numerator: Column, denominator: Column) -> Column:
    return F.round(F.try_divide(numerator, denominator), 12)


def ratio_status(numerator: Column, denominator: Column, rule: str) -> Column:
    """Missing, then zero, then sign; the order of the checks is part of the result."""
    status = F.when(numerator.isNull() | denominator.isNull(), F.lit("missing_inputs")).when(
        denominator == 0, F.lit("zero_denominator")
    )
    if rule == "positive":
        status = status.when(denominator < 0, F.lit("non_positive_denominator"))
    return status.otherwise(F.lit(CALCULATED))


def _lineage(role: str, field: str) -> Column:
    fact = F.col(field)
    return F.struct(
        F.lit(role).alias("role"),
        F.lit(field).alias("canonical_field_name"),
        fact["value"].alias("value"),
        F.coalesce(fact["value_status"], F.lit("fact_not_available")).alias("value_status"),
        fact["raw_record_id"].alias("raw_record_id"),
        fact["fetched_at"].alias("fetched_at"),
    )


def ratio_metrics(
    facts: DataFrame,
    definitions: Sequence[tuple[str, str, str, str]] = RATIO_METRICS,
    keys: Sequence[str] = KEYS,
    version: str = METRIC_DEFINITION_VERSION,
) -> DataFrame:
    """Every configured ratio for every report, one row each, with input lineage."""
    fields = sorted({f for _, n, d, _ in definitions for f in (n, d)})
    wide = latest_wide(facts, fields, keys)
    items = []
    for name, n, d, rule in definitions:
        top, bottom = F.col(n), F.col(d)
        status = ratio_status(top["value"], bottom["value"], rule)
        items.append(
            F.struct(
                F.lit(name).alias("metric_name"),
                F.when(status == CALCULATED, ratio_value(top["value"], bottom["value"])).alias("value"),
                status.alias("calculation_status"),
                F.lit(f"{n} / {d}").alias("formula"),
                F.coalesce(
                    F.greatest(top["available_from"], bottom["available_from"]), F.col("identity.available_from")
                ).alias("available_from"),
                F.coalesce(
                    F.greatest(top["fetched_at"], bottom["fetched_at"]), F.col("identity.fetched_at")
                ).alias("fetched_at"),
                F.array(_lineage("numerator", n), _lineage("denominator", d)).alias("input_facts"),
            )
        )
    rows = wide.select(*keys, "identity", F.explode(F.array(*items)).alias("m"))
    return rows.select(
        *keys,
        F.col("identity.security_name").alias("security_name"),
        F.col("identity.report_type").alias("report_type"),
        F.col("identity.filing_date").alias("filing_date"),
        "m.available_from",
        "m.fetched_at",
        "m.metric_name",
        "m.value",
        F.lit("ratio").alias("unit"),
        "m.calculation_status",
        "m.formula",
        F.lit(False).alias("annualized"),
        F.lit(version).alias("metric_definition_version"),
        "m.input_facts",
    )


def growth(current: Column, prior: Column) -> tuple[Column, Column]:
    """(value, status) of current / prior - 1. A negative prior flips the sign, as defined."""
    status = (
        F.when(current.isNull(), F.lit("missing_current_inputs"))
        .when(prior.isNull(), F.lit("missing_prior_inputs"))
        .when(prior == 0, F.lit("zero_denominator"))
        .otherwise(F.lit(CALCULATED))
    )
    return F.when(status == CALCULATED, F.round(F.try_divide(current, prior) - 1, 12)), status


def average_ratio(top: Column, current: Column, opening: Column) -> tuple[Column, Column]:
    """(value, status) of top over the mean of the current and the opening balance."""
    mean = (current + opening) / 2
    status = (
        F.when(top.isNull() | current.isNull(), F.lit("missing_current_inputs"))
        .when(opening.isNull(), F.lit("missing_opening_inputs"))
        .when(mean == 0, F.lit("zero_denominator"))
        .otherwise(F.lit(CALCULATED))
    )
    return F.when(status == CALCULATED, F.round(F.try_divide(top, mean), 12)), status


def invested_capital(equity: Column, cash: Column, debts: Sequence[Column]) -> Column:
    """Equity plus debt minus cash; null when any part is missing."""
    return equity + reduce(lambda a, b: a + b, debts) - cash


def return_on_capital(
    profit: Column, tax: Column, pretax: Column, current: Column, opening: Column
) -> tuple[Column, Column]:
    """(value, status) of taxed operating profit over mean invested capital."""
    mean = (current + opening) / 2
    status = (
        F.when(
            profit.isNull() | tax.isNull() | pretax.isNull() | current.isNull(), F.lit("missing_current_inputs")
        )
        .when(opening.isNull(), F.lit("missing_opening_inputs"))
        .when(pretax == 0, F.lit("zero_tax_rate_denominator"))
        .when(mean == 0, F.lit("zero_denominator"))
        .otherwise(F.lit(CALCULATED))
    )
    taxed = profit * (F.lit(1.0) - F.try_divide(tax, pretax))
    return F.when(status == CALCULATED, F.round(F.try_divide(taxed, mean), 12)), status


def prior_year(period: Column) -> Column:
    """The same reporting day one year earlier."""
    return F.add_months(period, -12)


def opening_day(period: Column) -> Column:
    """31 December of the year before."""
    return F.make_date(F.year(period) - 1, F.lit(12), F.lit(31))


def align_periods(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    current: Sequence[str],
    prior: Sequence[str] = (),
    opening: Sequence[str] = (),
) -> DataFrame:
    """Bring the prior comparable period and the opening balance next to each period.

    ``df`` has one row per (keys, period), the period a quarter-end date. Instead of
    joining the table to itself, each row is sent to the periods that need it: its own,
    the same day one year later, and, from a year end, the four quarters of the next
    year. One aggregation then assembles them, so the input is read and shuffled once.
    The result has struct columns ``current``, ``prior`` and ``opening``.
    """
    shapes = {"current": current, "prior": prior, "opening": opening}
    packed = {
        role: F.struct(*[F.col(c) for c in columns]) if columns else None for role, columns in shapes.items()
    }
    kinds = df.select(*[c.alias(r) for r, c in packed.items() if c is not None]).schema

    def send(target: Column, role: str) -> Column:
        slots = [
            (packed[f.name] if f.name == role else F.lit(None).cast(f.dataType)).alias(f.name) for f in kinds.fields
        ]
        return F.struct(target.alias("__target"), *slots)

    day = F.col(period)
    sends = [send(day, "current")]
    if prior:
        sends.append(send(F.add_months(day, 12), "prior"))
    targets = F.array(*sends)
    if opening:
        # Quarter ends of the following year, from its first to its last.
        following = F.array(*[send(F.last_day(F.add_months(day, m)), "opening") for m in (3, 6, 9, 12)])
        targets = F.when(F.date_format(day, "MM-dd") == "12-31", F.concat(targets, following)).otherwise(targets)
    sent = df.select(*keys, F.inline(targets))
    aligned = sent.groupBy(*keys, "__target").agg(*[F.max(f.name).alias(f.name) for f in kinds.fields])
    return aligned.where(F.col("current").isNotNull()).withColumnRenamed("__target", period)


CAPITAL_FIELDS = ["total_equity", "monetary_funds", *DEBT_ITEMS]
ADVANCED_FIELDS = [
    "revenue",
    "net_income_parent",
    "equity_parent",
    "operating_profit",
    "income_tax_expense",
    "total_profit",
    "net_cash_flow_operating",
    "capital_expenditure_cash",
    *CAPITAL_FIELDS,
]


def advanced_metrics(facts: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """(metrics, rejected facts): growth, average returns and free cash flow, five rows per report.

    ``period_end`` must be a date at a quarter end; facts at other days or without one come back
    as they are beside the metrics.
    """
    wide = latest_wide(facts, ADVANCED_FIELDS).where(is_period_end(F.col("period_end")))
    flat = wide.select(
        *KEYS,
        "identity",
        *[F.col(f"{f}.value").alias(f) for f in ADVANCED_FIELDS],
        *[F.col(f"{f}.available_from").alias(f"af_{f}") for f in ADVANCED_FIELDS],
    )
    capital = invested_capital(F.col("total_equity"), F.col("monetary_funds"), [F.col(d) for d in DEBT_ITEMS])
    flat = flat.withColumn("capital", capital).withColumn(
        "af_capital", F.greatest(*[F.col(f"af_{f}") for f in CAPITAL_FIELDS])
    )
    aligned = align_periods(
        flat,
        ["security_code"],
        "period_end",
        current=[c for c in flat.columns if c not in KEYS],
        prior=["revenue", "net_income_parent", "af_revenue", "af_net_income_parent"],
        opening=["equity_parent", "capital", "af_equity_parent", "af_capital"],
    )
    rows = aligned.select(
        *KEYS,
        "current.*",
        *[F.col(f"prior.{c}").alias(f"prior_{c}") for c in ("revenue", "net_income_parent", "af_revenue", "af_net_income_parent")],
        *[F.col(f"opening.{c}").alias(f"open_{c}") for c in ("equity_parent", "capital", "af_equity_parent", "af_capital")],
    )
    value = {f: F.col(f) for f in ADVANCED_FIELDS}
    cash_status = F.when(
        value["net_cash_flow_operating"].isNull() | value["capital_expenditure_cash"].isNull(),
        F.lit("missing_current_inputs"),
    ).otherwise(F.lit(CALCULATED))
    cash = F.round(value["net_cash_flow_operating"] - value["capital_expenditure_cash"], 6)
    before, start = prior_year(F.col("period_end")), opening_day(F.col("period_end"))
    none = F.lit(None).cast("date")

    def item(name: str, pair: tuple[Column, Column], prior_end: Column, opening_end: Column, available: list[str]) -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"),
            pair[0].alias("value"),
            pair[1].alias("calculation_status"),
            F.lit("CNY" if name == "free_cash_flow" else "ratio").alias("unit"),
            prior_end.alias("prior_comparable_period_end"),
            opening_end.alias("opening_balance_period_end"),
            F.coalesce(F.greatest(*[F.col(a) for a in available]), F.col("identity.available_from")).alias("available_from"),
        )

    items = [
        item("revenue_growth_yoy", growth(value["revenue"], F.col("prior_revenue")), before, none, ["af_revenue", "prior_af_revenue"]),
        item(
            "net_income_growth_yoy",
            growth(value["net_income_parent"], F.col("prior_net_income_parent")),
            before, none, ["af_net_income_parent", "prior_af_net_income_parent"],
        ),
        item(
            "roe_parent_average",
            average_ratio(value["net_income_parent"], value["equity_parent"], F.col("open_equity_parent")),
            none, start, ["af_net_income_parent", "af_equity_parent", "open_af_equity_parent"],
        ),
        item(
            "roic_average",
            return_on_capital(
                value["operating_profit"], value["income_tax_expense"], value["total_profit"],
                F.col("capital"), F.col("open_capital"),
            ),
            none, start,
            ["af_operating_profit", "af_income_tax_expense", "af_total_profit", "af_capital", "open_af_capital"],
        ),
        item("free_cash_flow", (cash, cash_status), none, none, ["af_net_cash_flow_operating", "af_capital_expenditure_cash"]),
    ]
    exploded = rows.select(*KEYS, "identity", F.explode(F.array(*items)).alias("m"))
    metrics = exploded.select(
        *KEYS,
        F.col("identity.security_name").alias("security_name"),
        "m.*",
        F.lit(False).alias("annualized"),
        F.lit(version).alias("metric_definition_version"),
    )
    return metrics, unsupported_periods(facts)


def unsupported_periods(facts: DataFrame, period: str = "period_end") -> DataFrame:
    """Fact periods that end on no quarter end."""
    return facts.where(~F.coalesce(is_period_end(F.col(period)), F.lit(False)))


def metric_coverage(metrics: DataFrame) -> DataFrame:
    """Securities, records and calculated records per metric and period."""
    return metrics.groupBy("metric_name", "period_end").agg(
        F.countDistinct("security_code").alias("security_count"),
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("calculation_status") == CALCULATED).alias("calculated_count"),
        F.count_if(F.col("calculation_status") != CALCULATED).alias("unavailable_count"),
    )


def status_histogram(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric_name", "calculation_status").agg(F.count(F.lit(1)).alias("record_count"))
