"""Wide vendor rows to typed, keyed tables with lineage, and back to a complete grid."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.coerce import (
    compact_date,
    exchange_suffix,
    fund_type,
    is_listed_code,
    iso_text,
    membership_list,
    membership_text,
    number,
    number_rejected,
)
from tidemark.functions.names import index_family, report_label_period, report_label_type
from tidemark.session import settle

_TEXT_LIST = "array<string>"


def cells(rows: DataFrame, keys: Sequence[str], entries: str = "entries") -> DataFrame:
    """Long cells (keys, raw_field_name, cell) of rows held as map<string, variant>."""
    return rows.select(*keys, F.explode(entries).alias("raw_field_name", "cell"))


def cell_text(cell: Column) -> Column:
    """Scalar cell as text; JSON null and missing are null."""
    return F.try_variant_get(cell, "$", "string")


def cell_list(cell: Column) -> Column:
    """A cell that is a text with ``;`` or a list of texts, as a clean list."""
    listed = F.try_variant_get(cell, "$", _TEXT_LIST)
    return F.when(listed.isNotNull(), membership_list(listed)).otherwise(membership_text(cell_text(cell)))


#: Vendor rows of one part: their cells are sorted in one task.
PART_ROWS = 100_000


def spread(rows: DataFrame, keys: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """Vendor rows dealt by ``keys`` into parts of about ``part_rows`` rows.

    A row is opened into tens of cells that are combined again in the task that has the row, so
    what a task holds depends on the part and not on the size of the table.
    """
    return rows.repartition(max(1, math.ceil(rows.count() / part_rows)), *keys)


def described_cells(rows: DataFrame, descriptors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells joined to the parsed names of their columns.

    The descriptors are one row per distinct column name of the vendor, a few hundred.
    """
    from tidemark.operators.joins import join_checked

    return join_checked(cells(rows, keys), descriptors, ["raw_field_name"], "left")


def _present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def lineage_entry() -> Column:
    text = cell_text(F.col("cell"))
    return F.struct(
        F.col("raw_field_name").alias("raw_field_name"),
        F.col("unit").alias("unit"),
        F.col("confidence").alias("confidence"),
        F.when(_present(text), F.lit("present")).otherwise(F.lit("missing_in_source")).alias("value_status"),
    )


def pick(name: str, value: Column, condition: Column | None = None) -> Column:
    """The value of one canonical field inside an aggregation over a row's cells."""
    matched = F.col("canonical_field_name") == name
    if condition is not None:
        matched = matched & condition
    return F.max(F.when(matched, value))


#: Fields that have a value for each adjustment; the unadjusted one is used.
PRICES = ["open", "high", "low", "close"]


def lineage_map(names: Sequence[str]) -> Column:
    """map<canonical name, lineage> of a row; a row has tens of cells."""
    name = F.col("canonical_field_name")
    adjusted = name.isin(*PRICES) & F.coalesce(F.col("adjustment_type") != "unadjusted", F.lit(True))
    entry = F.struct(name.alias("key"), lineage_entry().alias("value"))
    entries = F.sort_array(F.collect_list(F.when(name.isin(*names) & ~adjusted, entry)))
    # Two raw names may stand for one field: the first in order is its lineage.
    return F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform(entries, lambda e: e["key"])),
            lambda key: F.filter(entries, lambda e: e["key"] == key)[0],
        )
    )


def split_market(described: DataFrame, keys: Sequence[str], fetched_at: str = "fetched_at") -> dict[str, DataFrame]:
    """security_master, market_bars_daily, valuation_snapshots and rejects from one row pass.

    ``described`` are cells with parsed names, one vendor row per ``keys``. Prices are the
    unadjusted ones. Numbers that do not parse reject the row with a reason.
    """
    text = cell_text(F.col("cell"))
    unadjusted = F.col("adjustment_type") == "unadjusted"
    prices = PRICES
    numbers = [*prices, "volume", "turnover", "market_cap", "pe_ttm"]
    per_number = []
    for n in numbers:
        condition = unadjusted if n in prices else None
        per_number += [pick(n, text, condition).alias(f"t_{n}")]
    grouped = described.groupBy(*keys).agg(
        pick("security_code", text).alias("security_code"),
        pick("security_name", text).alias("security_name"),
        pick("market_memberships", cell_list(F.col("cell"))).alias("market_memberships"),
        pick("listing_date", text).alias("t_listing_date"),
        pick("listing_status", F.nullif(text, F.lit(""))).alias("listing_status"),
        *per_number,
        pick("close", F.col("as_of_date"), unadjusted).alias("trade_date"),
        pick("market_cap", F.col("as_of_date")).alias("valuation_date"),
        pick("close", F.col("unit"), unadjusted).alias("currency"),
        pick("volume", F.col("unit")).alias("volume_unit"),
        pick("turnover", F.col("unit")).alias("turnover_currency"),
        pick("market_cap", F.col("unit")).alias("market_cap_currency"),
        F.max(fetched_at).alias("fetched_at"),
        lineage_map(["security_code", "security_name", "market_memberships", "listing_date", "listing_status"]).alias("master_lineage"),
        lineage_map(["security_code", *prices, "volume", "turnover"]).alias("bar_lineage"),
        lineage_map(["security_code", "market_cap", "pe_ttm"]).alias("valuation_lineage"),
    )
    typed = grouped.select(
        *[c for c in grouped.columns if not c.startswith("t_")],
        *[number(F.col(f"t_{n}")).alias(n) for n in numbers],
        compact_date(F.col("t_listing_date")).alias("listing_date"),
        F.array_compact(
            F.array(
                F.when(~is_listed_code(F.col("security_code")), F.lit("unsupported_security_code")),
                F.when(~_present(F.coalesce("security_name", F.lit(""))), F.lit("missing_security_name")),
                F.when(F.coalesce(F.size("market_memberships"), F.lit(0)) <= 0, F.lit("missing_memberships")),
                F.when(_present(F.col("t_listing_date")) & compact_date(F.col("t_listing_date")).isNull(), F.lit("invalid_listing_date")),
                *[F.when(number_rejected(F.col(f"t_{n}")), F.lit(f"invalid_number:{n}")) for n in numbers],
                F.when(_present(F.col("t_pe_ttm")) & ~_present(F.coalesce("t_market_cap", F.lit(""))), F.lit("incomplete_valuation")),
                F.when(number(F.col("t_market_cap")) <= 0, F.lit("non_positive_market_cap")),
            )
        ).alias("reasons"),
    )
    rejected = typed.where(F.size("reasons") > 0)
    good = typed.where(F.size("reasons") == 0)
    local_day = F.to_date(F.convert_timezone(F.current_timezone(), F.lit(fixed.PROJECT_TIME_ZONE), F.col("fetched_at").cast("timestamp_ntz")))
    master = good.select(
        *keys, "security_code", local_day.alias("observed_date"), exchange_suffix(F.col("security_code")).alias("exchange"),
        "security_name", "market_memberships", "listing_date", "listing_status", "fetched_at",
        F.col("master_lineage").alias("field_lineage"),
    )
    bars = good.where(F.col("close").isNotNull()).select(
        *keys, "security_code", F.to_date("trade_date").alias("trade_date"), F.lit("unadjusted").alias("adjustment_type"),
        *prices, "volume", "volume_unit", "turnover", "turnover_currency", "currency", "fetched_at",
        F.col("bar_lineage").alias("field_lineage"),
    )
    valuations = good.where(F.col("market_cap").isNotNull()).select(
        *keys, "security_code", F.to_date("valuation_date").alias("as_of_date"), "market_cap", "market_cap_currency",
        "pe_ttm", "fetched_at", F.col("valuation_lineage").alias("field_lineage"),
    )
    return {"security_master": master, "market_bars_daily": bars, "valuation_snapshots": valuations, "rejected": rejected}


FUND_NUMBERS = {
    "etf_price": "price", "change_pct": "change_pct", "volume": "volume", "turnover": "turnover",
    "fund_size": "fund_size", "nav": "nav", "premium_discount_rate": "premium_discount_rate",
    "management_fee_rate": "management_fee_rate", "custody_fee_rate": "custody_fee_rate",
    "tracking_error": "tracking_error",
}


def fund_snapshots(described: DataFrame, keys: Sequence[str], as_of: str = "as_of") -> tuple[DataFrame, DataFrame]:
    """(snapshots, rejected) of exchange-traded funds inside the configured scope."""
    text = cell_text(F.col("cell"))
    grouped = described.groupBy(*keys).agg(
        pick("etf_code", F.trim(text)).alias("etf_code"),
        pick("etf_name", F.trim(text)).alias("etf_name"),
        pick("tracked_index", F.trim(text)).alias("tracked_index"),
        pick("fund_type", F.coalesce(membership_list(F.try_variant_get("cell", "$", _TEXT_LIST)), F.array(F.trim(text)))).alias("fund_type_memberships"),
        pick("etf_listing_date", F.regexp_replace(text, "-", "")).alias("t_listing_date"),
        pick("listing_status", F.nullif(F.trim(text), F.lit(""))).alias("listing_status"),
        *[pick(n, text).alias(f"t_{n}") for n in FUND_NUMBERS],
        F.max(as_of).alias("as_of_date"),
        F.max("fetched_at").alias("fetched_at"),
        lineage_map(["etf_code", "etf_name", "tracked_index", "fund_type", "etf_listing_date", "listing_status", *FUND_NUMBERS]).alias("field_lineage"),
    )
    typed = grouped.select(
        *keys, "etf_code", "etf_name", exchange_suffix(F.col("etf_code")).alias("exchange"), "as_of_date",
        "tracked_index", index_family(F.col("tracked_index")).alias("tracked_index_family"),
        fund_type(F.col("fund_type_memberships"), fixed.FUND_TYPE).alias("fund_type"), "fund_type_memberships",
        compact_date(F.col("t_listing_date")).alias("listing_date"), "listing_status",
        *[number(F.col(f"t_{n}")).alias(out) for n, out in FUND_NUMBERS.items()],
        "fetched_at", "field_lineage",
        F.array_compact(
            F.array(
                F.when(~F.coalesce(exchange_suffix(F.col("etf_code")).isin(*fixed.STOCK_EXCHANGES), F.lit(False)), F.lit("outside_allowed_exchanges")),
                F.when(index_family(F.col("tracked_index")).isNull(), F.lit("outside_index_scope")),
                F.when(fund_type(F.col("fund_type_memberships"), fixed.FUND_TYPE).isNull(), F.lit("outside_fund_type")),
                *[F.when(number_rejected(F.col(f"t_{n}")), F.lit(f"invalid_number:{n}")) for n in FUND_NUMBERS],
            )
        ).alias("reasons"),
    )
    return typed.where(F.size("reasons") == 0).drop("reasons"), typed.where(F.size("reasons") > 0)


REPORT_META = [
    "security_code", "security_name", "period_end", "report_type", "report_period_label", "filing_date",
    "available_from", "fetched_at", "raw_record_id", "query_group",
]


def financial_tables(described: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """facts (long), reports, missing report rows and rejects of financial pages.

    ``described`` are cells with parsed names and the columns fetched_at (timestamp),
    raw_record_id and query_group; one vendor row per ``keys``. Every page column becomes
    a fact, present or explicitly missing. Cells of rows that :func:`spread` has dealt by ``keys`` are not
    shuffled again.
    """
    keys = list(keys)
    text = cell_text(F.col("cell"))
    is_fact = F.col("category") == "financial"
    of_report = F.col("category").isin("financial", "financial_metadata") & F.col("period_end").isNotNull()
    per_report = described.withColumn("period_end", F.when(of_report, F.col("period_end")))
    # Cells of no report are a group without a period; it holds the identity of its row.
    grouped = per_report.groupBy(*keys, "period_end", "fetched_at", "raw_record_id", "query_group").agg(
        pick("security_code", text).alias("security_code"),
        pick("security_name", text).alias("security_name"),
        pick("filing_date", text).alias("t_filing_date"),
        pick("report_period_label", text).alias("report_period_label"),
        pick("filing_date", F.col("report_type")).alias("field_report_type"),
        F.collect_list(
            F.when(
                is_fact,
                F.struct("canonical_field_name", "statement_type", "value_nature", "unit", text.alias("text"), "raw_field_name", "confidence"),
            )
        ).alias("__facts"),
        F.count_if(is_fact & _present(text)).alias("present_fact_count"),
        F.count_if(is_fact).alias("fact_count"),
    )
    row = Window.partitionBy(*keys)
    named = grouped.withColumns({c: F.max(c).over(row) for c in ("security_code", "security_name")})
    joined = named.where(F.col("period_end").isNotNull())
    absent = (
        ~_present(F.coalesce("t_filing_date", F.lit(""))) & ~_present(F.coalesce("report_period_label", F.lit("")))
        & (F.col("present_fact_count") == 0)
    )
    filing = compact_date(F.col("t_filing_date"))
    fetched_day = F.to_date(F.convert_timezone(F.current_timezone(), F.lit(fixed.PROJECT_TIME_ZONE), F.col("fetched_at").cast("timestamp_ntz")))
    bad_number = F.exists("__facts", lambda f: number_rejected(f["text"]))
    marked = joined.withColumn("absent", absent).withColumn("filing_date", iso_text(filing)).withColumn(
        "report_type", report_label_type(F.col("report_period_label"))
    ).withColumn(
        "reasons",
        F.array_compact(
            F.array(
                F.when(~is_listed_code(F.col("security_code")), F.lit("unsupported_security_code")),
                F.when(F.col("filing_date").isNull() | ~_present(F.coalesce("report_period_label", F.lit(""))), F.lit("missing_report_metadata")),
                F.when(
                    ~report_label_period(F.col("report_period_label")).eqNullSafe(F.col("period_end"))
                    | ~F.col("report_type").eqNullSafe(F.col("field_report_type")),
                    F.lit("label_period_mismatch"),
                ),
                F.when(F.col("filing_date") < F.col("period_end"), F.lit("filed_before_period_end")),
                F.when(filing > fetched_day, F.lit("filed_after_fetch")),
                F.when(bad_number, F.lit("invalid_number")),
            )
        ),
    ).withColumn("available_from", F.col("filing_date"))
    marked = settle(marked)  # four tables are read from it
    missing = marked.where(F.col("absent")).select(
        *keys, "security_code", "security_name", "period_end", "raw_record_id", F.lit("report_not_present_in_source").alias("reason")
    )
    good = marked.where(~F.col("absent") & (F.size("reasons") == 0))
    reports = good.select(
        *keys, *REPORT_META, F.col("fact_count"), F.col("present_fact_count"),
        (F.col("fact_count") - F.col("present_fact_count")).alias("missing_fact_count"),
    )
    facts = good.select(*keys, *REPORT_META, F.inline("__facts")).select(
        *keys, *REPORT_META, "canonical_field_name", "statement_type", "value_nature",
        number(F.col("text")).alias("value"), "unit",
        F.when(_present(F.coalesce("text", F.lit(""))), F.lit("present")).otherwise(F.lit("missing_in_source")).alias("value_status"),
        F.lit("source_row").alias("source_role"),
    )
    rejected = marked.where(~F.col("absent") & (F.size("reasons") > 0))
    return {"facts": facts, "reports": reports, "missing": missing, "rejected": rejected}


def complete_grid(
    facts: DataFrame,
    reports: DataFrame,
    group: Sequence[str],
    report_keys: Sequence[str],
    field: str = "canonical_field_name",
    attributes: Sequence[str] = ("statement_type", "value_nature", "unit"),
) -> DataFrame:
    """Facts plus explicit nulls for fields seen elsewhere in the same query group.

    The fields of a group are few; each report of the group gets the missing ones. The
    join runs on the group columns; its small side is broadcast only after counting.
    """
    from tidemark.operators.joins import join_checked

    attributes = list(attributes)
    template = facts.groupBy(*group, field).agg(
        *([F.min(F.struct(*attributes)).alias("__attributes")] if attributes else [F.count(F.lit(1)).alias("__n")])
    )
    grid = join_checked(reports.select(*dict.fromkeys([*report_keys, *group])), template, list(group), "inner")
    held = facts.select(*report_keys, field).distinct()
    absent = grid.join(held, [*report_keys, field], "left_anti")
    filled = absent.select(
        *[c for c in absent.columns if c not in ("__attributes", "__n")],
        *([F.col(f"__attributes.{a}").alias(a) for a in attributes]),
        F.lit("missing_in_source").alias("value_status"),
        F.lit("query_batch_expected_field").alias("source_role"),
    )
    return facts.unionByName(filled, allowMissingColumns=True)
