"""Completeness, contracts and reconciliation.

Every check returns the rows that break a rule (or a status per group); nothing is
raised and nothing is dropped. Counts are combined before they are shuffled, and checks
that need the row before (order, gaps) use range partitions, so a hot group is not read
by one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import with_previous
from tidemark.session import settle


@dataclass(frozen=True)
class Rule:
    """A rule and the expression that is true when a row breaks it."""

    rule_id: str
    broken: Column


def broken_rules(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.broken, F.lit(r.rule_id)) for r in rules]))


def violations(df: DataFrame, keys: Sequence[str | Column], rules: Sequence[Rule]) -> DataFrame:
    """One row per (key, broken rule)."""
    return df.select(*keys, F.explode(broken_rules(rules)).alias("rule_id"))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reasons)."""
    marked = df.withColumn("reasons", broken_rules(rules))
    return (
        marked.where(F.size("reasons") == 0).drop("reasons"),
        marked.where(F.size("reasons") > 0),
    )


# --- keys ---------------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def incomplete_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.where(missing)


def key_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows, distinct keys, rows with an incomplete key, keys that occur more than once."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max(missing).alias("__missing"))
    return per_key.agg(
        F.sum("__n").alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.sum(F.when(F.col("__missing"), F.col("__n")).otherwise(0)).alias("incomplete_count"),
        F.count_if((F.col("__n") > 1) & ~F.col("__missing")).alias("duplicate_key_count"),
    ).select(F.lit(table).alias("table_name"), "*")


def orphans(child: DataFrame, parent: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Child rows that reference nothing."""
    return child.join(parent, on, "left_anti")


# --- reconciliation -----------------------------------------------------------------
def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Full outer comparison of two keyed tables.

    Status: ``left_only``, ``right_only``, ``match`` or ``conflict`` with the differing
    columns; nulls compare equal to nulls.
    """
    a = left.select(*keys, F.struct(*compare).alias("left_row"), F.lit(True).alias("__l"))
    b = right.select(*keys, F.struct(*compare).alias("right_row"), F.lit(True).alias("__r"))
    joined = a.join(b, list(keys), "full")
    differing = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"left_row.{c}").eqNullSafe(F.col(f"right_row.{c}")), F.lit(c))
                for c in sorted(compare)
            ]
        )
    )
    status = (
        F.when(F.col("__r").isNull(), F.lit("left_only"))
        .when(F.col("__l").isNull(), F.lit("right_only"))
        .when(F.size(differing) == 0, F.lit("match"))
        .otherwise(F.lit("conflict"))
    )
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return joined.select(*keys, status.alias("status"), F.when(both, differing).alias("differing"), "left_row", "right_row")


def log_reconciliation(raw: DataFrame, log: DataFrame, path: str = "path", record: str = "record_id") -> DataFrame:
    """Raw snapshots against their log: missing, dangling, repeated and mismatched entries."""
    logged = log.groupBy(path).agg(
        F.count(F.lit(1)).alias("entries"), F.min(record).alias("__lo"), F.max(record).alias("__hi")
    )
    stored = raw.select(path, F.col(record).alias("__record"), F.lit(True).alias("__stored"))
    joined = stored.join(logged, path, "full")
    status = (
        F.when(F.col("__stored").isNull(), F.lit("dangling_log_entry"))
        .when(F.col("entries").isNull(), F.lit("missing_log_entry"))
        .when(F.col("entries") > 1, F.lit("duplicate_log_entry"))
        .when(~F.col("__lo").eqNullSafe(F.col("__record")), F.lit("record_id_mismatch"))
        .otherwise(F.lit("ok"))
    )
    return joined.select(path, status.alias("status"))


def split_differences(source: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows lost or invented by a split export, multiplicities included."""
    columns = source.columns
    lost = source.exceptAll(parts.select(*columns)).withColumn("difference", F.lit("lost"))
    extra = parts.select(*columns).exceptAll(source).withColumn("difference", F.lit("invented"))
    return lost.unionByName(extra)


def index_mismatches(index: DataFrame, detail: DataFrame, key: str, counts: Sequence[str]) -> DataFrame:
    """Keys on one side only, or with different counts, between an index and its detail."""
    return reconcile(index, detail, [key], counts).where(F.col("status") != "match")


def summary_mismatches(summary: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Published summary values that the data does not give."""
    return reconcile(summary, actual, keys, columns).where(F.col("status") != "match")


# --- pages --------------------------------------------------------------------------
def page_summary(
    pages: DataFrame,
    group: Sequence[str],
    page: str = "page",
    limit: str = "page_limit",
    total: str = "total",
    returned: str = "returned",
) -> DataFrame:
    """Coverage and completeness of each paged query.

    Complete: one limit, one total, no page twice, pages exactly 1..ceil(total / limit),
    and as many rows returned as reported.
    """
    grouped = pages.groupBy(*group).agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.countDistinct(page).alias("page_count"),
        F.min(page).cast("long").alias("first_page"),
        F.max(page).cast("long").alias("last_page"),
        F.min(limit).cast("long").alias("__limit_lo"),
        F.max(limit).cast("long").alias("__limit_hi"),
        F.min(total).cast("long").alias("__total_lo"),
        F.max(total).cast("long").alias("__total_hi"),
        F.sum(returned).cast("long").alias("returned_count"),
    )
    one_limit = F.col("__limit_lo") == F.col("__limit_hi")
    one_total = F.col("__total_lo") == F.col("__total_hi")
    grouped = grouped.withColumn("reported_total", F.when(one_total, F.col("__total_lo"))).withColumn(
        "page_limit", F.when(one_limit, F.col("__limit_lo"))
    )
    expected = F.greatest(
        F.lit(1).cast("long"), F.ceil(F.try_divide(F.col("reported_total"), F.col("page_limit"))).cast("long")
    )
    grouped = grouped.withColumn(
        "expected_pages", F.when(F.col("page_limit").isNotNull() & F.col("reported_total").isNotNull(), expected)
    )
    contiguous = (F.col("first_page") == 1) & (F.col("last_page") == F.col("page_count"))
    complete = (
        contiguous & (F.col("snapshot_count") == F.col("page_count")) & (F.col("page_count") == F.col("expected_pages"))
    )
    problems = F.array_compact(
        F.array(
            F.when(F.col("snapshot_count") != F.col("page_count"), F.lit("duplicate_pages")),
            F.when(F.coalesce(~one_total, F.lit(True)), F.lit("inconsistent_total")),
            F.when(F.coalesce(~one_limit, F.lit(True)), F.lit("inconsistent_limit")),
            F.when(~contiguous, F.lit("non_contiguous_pages")),
            F.when(contiguous & (F.col("page_count") < F.col("expected_pages")), F.lit("incomplete_pages")),
            F.when(complete & (F.col("returned_count") != F.col("reported_total")), F.lit("returned_count_mismatch")),
        )
    )
    return grouped.withColumn("problems", problems).withColumn(
        "complete", F.coalesce(complete, F.lit(False)) & (F.size("problems") == 0)
    ).drop("__limit_lo", "__limit_hi", "__total_lo", "__total_hi")


def page_gaps(pages: DataFrame, group: Sequence[str], page: str = "page") -> DataFrame:
    """Ranges of absent pages before, between and after nothing: one row per gap.

    Gaps are found from the distinct page before, so no list of expected pages is built.
    """
    distinct = pages.select(*group, F.col(page).cast("long").alias(page)).distinct()
    placed = with_previous(distinct, group, [F.col(page).asc()], [page], prefix="__prev_")
    before = F.coalesce(F.col(f"__prev_{page}"), F.lit(0).cast("long"))
    return placed.where(F.col(page) > before + 1).select(
        *group, (before + 1).alias("gap_start"), (F.col(page) - 1).alias("gap_end")
    )


def resume_points(pages: DataFrame, group: Sequence[str], page: str = "page", expected: str = "expected_pages") -> DataFrame:
    """Next page to fetch per group (null when complete) and the pages still missing."""
    distinct = settle(
        pages.groupBy(*group, F.col(page).cast("long").alias(page)).agg(F.max(expected).cast("long").alias(expected))
    )
    first_gap = page_gaps(distinct, group, page).groupBy(*group).agg(F.min("gap_start").alias("gap_start"))
    held = distinct.groupBy(*group).agg(
        F.count(F.lit(1)).alias("present_pages"), F.max(page).alias("last_page"), F.max(expected).alias(expected)
    )
    joined = held.join(first_gap, list(group), "left")
    following = F.coalesce(F.col("gap_start"), F.col("last_page") + 1)
    return joined.select(
        *group,
        "present_pages",
        F.when(following <= F.col(expected), following).alias("next_page"),
        F.greatest(F.col(expected) - F.col("present_pages"), F.lit(0).cast("long")).alias("remaining_pages"),
    )


def has_more_conflicts(pages: DataFrame, group: Sequence[str], page: str = "page", has_more: str = "has_more") -> DataFrame:
    """Pages whose ``has_more`` disagrees with whether a later page exists."""
    last = pages.groupBy(*group).agg(F.max(page).alias("__last"))
    joined = pages.join(last, list(group))
    expected = F.col(page) < F.col("__last")
    return joined.where(F.col(has_more).isNotNull() & (F.col(has_more) != expected)).drop("__last")


def order_violations(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], code: str
) -> DataFrame:
    """Rows whose code is not strictly above the code before it, across page boundaries too."""
    placed = with_previous(df, group, order, [code], prefix="previous_")
    return placed.where(F.col(f"previous_{code}") >= F.col(code))


def pagination_conflict(requested: Column, reported: Column) -> Column:
    """True when the request and the response name different values."""
    return F.coalesce(requested != reported, F.lit(False))


def below_minimum(df: DataFrame, group: Sequence[str], member: Column, minimum: int) -> DataFrame:
    """Groups with fewer than ``minimum`` qualifying rows."""
    counted = df.groupBy(*group) if group else df.groupBy()
    return counted.agg(F.count_if(member).alias("qualifying")).where(F.col("qualifying") < minimum)


# --- row rules ----------------------------------------------------------------------
def price_bar_rules(
    open_: str = "open", high: str = "high", low: str = "low", close: str = "close",
    volume: str = "volume", turnover: str = "turnover",
) -> list[Rule]:
    o, h, low_, c, v, t = (F.col(x) for x in (open_, high, low, close, volume, turnover))
    ranged = h.isNotNull() & low_.isNotNull()
    return [
        Rule("non_positive_price", F.coalesce(F.least(o, h, low_, c) <= 0, F.lit(False))),
        Rule("high_below_low", ranged & (h < low_)),
        Rule("open_outside_range", ranged & (h >= low_) & ~o.between(low_, h)),
        Rule("close_outside_range", ranged & (h >= low_) & ~c.between(low_, h)),
        Rule("negative_volume", v < 0),
        Rule("negative_turnover", t < 0),
    ]


def filing_rules(
    period: str = "period_end", filed: str = "filing_date", fetched: str = "fetched_date",
    label_period: str = "label_period_end",
) -> list[Rule]:
    return [
        Rule("label_period_mismatch", ~F.col(label_period).eqNullSafe(F.col(period))),
        Rule("filed_before_period_end", F.col(filed) < F.col(period)),
        Rule("filed_after_fetch", F.col(filed) > F.col(fetched)),
    ]


def fact_count_rules() -> list[Rule]:
    total = F.col("present_fact_count") + F.col("missing_fact_count")
    return [
        Rule("negative_count", F.least("fact_count", "present_fact_count", "missing_fact_count") < 0),
        Rule("fact_count_identity", F.col("fact_count") != total),
    ]


def shard_rules(key: str, shard: str) -> list[Rule]:
    from tidemark.functions.text import shard_of

    return [Rule("wrong_shard", ~shard_of(F.col(key)).eqNullSafe(F.col(shard)))]


def provider_failure(success: Column, status_code: Column) -> Column:
    return F.coalesce(success == F.lit(False), F.lit(False)) | F.coalesce(status_code != 0, F.lit(False))


def empty_success(rows: Column, total: Column, success: Column, status_code: Column) -> Column:
    """A response that worked and found nothing."""
    worked = F.coalesce(success, F.lit(False)) | F.coalesce(status_code == 0, F.lit(False))
    return (F.coalesce(rows, F.lit(0)) == 0) & F.coalesce(total == 0, F.lit(False)) & worked


def declared_fields_mismatch(declared: Column, detected: Column) -> Column:
    """Declared names repeat, or are not exactly the detected ones."""
    return (F.size(declared) != F.size(F.array_distinct(declared))) | (
        F.sort_array(declared) != F.sort_array(detected)
    )


# --- configured tables --------------------------------------------------------------
def contract_rules(
    required: Sequence[str] = (),
    dates: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    ratios: Sequence[str] = (),
    enums: dict[str, Sequence[str]] | None = None,
) -> list[Rule]:
    """Rules of a text table (all columns as text) from its configuration."""
    from tidemark.functions.coerce import loose_date, number
    from tidemark.fixed_values import ISO_DATE_PATTERN

    def held(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))

    rules = [Rule(f"{c}:required", held(c) == "") for c in required]
    for c in dates:
        valid = held(c).rlike(ISO_DATE_PATTERN) & loose_date(held(c)).isNotNull()
        rules.append(Rule(f"{c}:no_iso_date", (held(c) != "") & ~valid))
    for c in non_negative:
        value = number(held(c))
        rules.append(Rule(f"{c}:negative", (held(c) != "") & F.coalesce(value < 0, F.lit(True))))
    for c in ratios:
        value = number(held(c))
        rules.append(
            Rule(f"{c}:no_ratio", (held(c) != "") & F.coalesce(~value.between(0, 1), F.lit(True)))
        )
    for c, allowed in (enums or {}).items():
        rules.append(Rule(f"{c}:not_listed", (held(c) != "") & ~held(c).isin(*allowed)))
    return rules


def unknown_references(references: Column, known: Column) -> Column:
    """True when a list of ids names one that is not known."""
    return F.size(F.array_except(references, known)) > 0


def repeated_ids(ids: Column) -> Column:
    return F.size(ids) != F.size(F.array_distinct(ids))


def card_rules() -> list[Rule]:
    from tidemark import fixed_values as fixed

    def outside(c: str, allowed: Sequence[str]) -> Column:
        return ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))

    weight = F.col("target_weight")
    return [
        Rule("security_code:required", F.coalesce(F.col("security_code"), F.lit("")) == ""),
        Rule("status:not_listed", outside("status", fixed.CARD_STATUSES)),
        Rule("thesis_status:not_listed", outside("thesis_status", fixed.THESIS_STATUSES)),
        Rule("valuation_status:not_listed", outside("valuation_status", fixed.VALUATION_STATUSES)),
        Rule("risk_status:not_listed", outside("risk_status", fixed.RISK_STATUSES)),
        Rule("target_weight:no_ratio", weight.isNotNull() & ~weight.between(0, 1)),
    ]


def research_rules() -> list[Rule]:
    """Rules of a research document with nested facts, inferences and valuation cases.

    Columns: status, priority, facts array<struct<fact_id, claim, source_url, as_of_date>>,
    inferences array<struct<confidence, supporting_fact_ids>>, valuation
    map<string, struct<method, estimated_value>>, thesis_breakers array<string>,
    red_team array<string>, proposed_weight double.
    """
    from tidemark import fixed_values as fixed

    facts, inferences, valuation = F.col("facts"), F.col("inferences"), F.col("valuation")
    ids = F.transform(facts, lambda f: f["fact_id"])
    ready = F.array_position(F.array(*[F.lit(s) for s in fixed.RESEARCH_STATUSES]), F.col("status")) >= (
        fixed.RESEARCH_STATUSES.index("decision_ready") + 1
    )
    weight = F.col("proposed_weight")
    cases = F.array(*[F.lit(c) for c in fixed.VALUATION_CASES])
    blank_text = lambda c: F.coalesce(c, F.lit("")) == ""
    incomplete = F.exists(
        F.map_values(valuation), lambda v: blank_text(v["method"]) | v["estimated_value"].isNull()
    )
    return [
        Rule("status:not_listed", ~F.coalesce(F.col("status").isin(*fixed.RESEARCH_STATUSES), F.lit(False))),
        Rule("priority:not_listed", ~F.coalesce(F.col("priority").isin("P0", "P1", "P2", "Reject"), F.lit(False))),
        Rule("fact_id:required", F.exists(ids, lambda i: blank_text(i))),
        Rule("fact_id:repeated", repeated_ids(F.filter(ids, lambda i: ~blank_text(i)))),
        Rule(
            "facts:incomplete",
            F.exists(facts, lambda f: blank_text(f["claim"]) | blank_text(f["source_url"]) | f["as_of_date"].isNull()),
        ),
        Rule(
            "confidence:not_listed",
            F.exists(inferences, lambda i: ~F.coalesce(i["confidence"].isin(*fixed.CONFIDENCE_VALUES), F.lit(False))),
        ),
        Rule(
            "supporting_fact_ids:required",
            F.exists(inferences, lambda i: F.coalesce(F.size(i["supporting_fact_ids"]), F.lit(0)) <= 0),
        ),
        Rule("supporting_fact_ids:unknown", F.exists(inferences, lambda i: unknown_references(i["supporting_fact_ids"], ids))),
        Rule("valuation:cases", F.sort_array(F.map_keys(valuation)) != F.sort_array(cases)),
        Rule("proposed_weight:no_ratio", weight.isNotNull() & ~weight.between(0, 1)),
        Rule("ready:facts", ready & (F.size(facts) == 0)),
        Rule("ready:thesis_breakers", ready & (F.size("thesis_breakers") == 0)),
        Rule("ready:valuation", ready & incomplete),
        Rule("ready:red_team", ready & (F.size(F.filter("red_team", lambda r: ~blank_text(r))) == 0)),
    ]


def decision_rules() -> list[Rule]:
    """Rules of a decision log row."""
    from tidemark import fixed_values as fixed

    weight = F.col("target_weight")
    active = ~F.col("action").isin("DEFER", "REJECT")
    return [
        Rule("action:not_listed", ~F.coalesce(F.col("action").isin(*fixed.DECISION_ACTIONS), F.lit(False))),
        Rule("final_authority:not_investor", ~F.col("final_authority").eqNullSafe(F.lit("investor"))),
        Rule("target_weight:no_ratio", weight.isNotNull() & ~weight.between(0, 1)),
        Rule("reason_for_decision:required", active & (F.coalesce(F.col("reason_for_decision"), F.lit("")) == "")),
        Rule("thesis_breakers:required", active & (F.size("thesis_breakers") == 0)),
    ]


def review_rules() -> list[Rule]:
    """Rules of a decision review row."""
    from tidemark import fixed_values as fixed

    return [
        Rule("thesis_status:not_listed", ~F.coalesce(F.col("thesis_status").isin("intact", "uncertain", "broken"), F.lit(False))),
        Rule("action_after_review:not_listed", ~F.coalesce(F.col("action_after_review").isin(*fixed.DECISION_ACTIONS), F.lit(False))),
    ]


# --- fields and responses of documents ----------------------------------------------
def field_audit(documents: DataFrame, group: Sequence[str], variant: str) -> DataFrame:
    """(group, documents, merged_schema): the one schema that all documents of a group fit, as text."""
    return documents.groupBy(*group).agg(
        F.count(variant).alias("documents"), F.schema_of_variant_agg(variant).alias("merged_schema")
    )


def canonical_digest(variant: Column) -> Column:
    """SHA-256 of a document, whatever the order of its members and the white space of its text."""
    return F.sha2(F.to_json(variant), 256)


def repeated_responses(responses: DataFrame, keys: Sequence[str], variant: str) -> DataFrame:
    """(keys, digest, copies) of equal documents fetched at equal keys; only digests are shuffled."""
    digests = responses.select(*keys, canonical_digest(F.col(variant)).alias("digest"))
    return digests.groupBy(*keys, "digest").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def declared_field_faults(responses: DataFrame, keys: Sequence[str], declared: str, detected: str) -> DataFrame:
    """Responses whose declared field names are empty, repeated or not those detected (arrays)."""
    names = F.coalesce(F.col(declared), F.array().cast("array<string>"))
    faults = F.array_compact(
        F.array(
            F.when(F.col(declared).isNull() | F.exists(names, lambda n: n.isNull() | (n == "")), F.lit("declared_fields_invalid")),
            F.when(F.size(F.array_distinct(names)) != F.size(names), F.lit("declared_fields_repeated")),
            F.when(~F.sort_array(names).eqNullSafe(F.sort_array(detected)), F.lit("declared_fields_differ")),
        )
    )
    return responses.select(*keys, F.explode(faults).alias("fault"))


# --- published sets -----------------------------------------------------------------
def screen_set_faults(
    rows: DataFrame, source_date: Column, exchanges: Sequence[str], excluded_prefixes: Sequence[str],
    code: str = "security_code", date: str = "as_of_date",
) -> DataFrame:
    """(code, fault) of screen rows that do not belong to their source, or occur twice.

    A row must have a code of the universe and the date of its source. One pass; a repeated code is one row
    of the result.
    """
    from tidemark.fixed_values import SECURITY_CODE_PATTERN

    digits, exchange = F.substring_index(code, ".", 1), F.substring_index(code, ".", -1)
    valid = F.coalesce(F.col(code).rlike(SECURITY_CODE_PATTERN) & exchange.isin(*exchanges), F.lit(False))
    outside = F.lit(False)
    for prefix in excluded_prefixes:
        outside = outside | digits.startswith(prefix)
    dated = F.col(date).cast("string").try_cast("date")
    checks = [
        (~valid, "invalid_code"),
        (valid & outside, "outside_universe"),
        (dated.isNull(), "invalid_date"),
        (dated != source_date, "date_mismatch"),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in checks]))
    each = rows.select(F.col(code).alias("code"), F.explode(found).alias("fault"))
    repeated = rows.groupBy(F.col(code).alias("code")).count().where("count > 1 AND code IS NOT NULL")
    return each.unionByName(repeated.select("code", F.lit("repeated_code").alias("fault")))


def fund_set_faults(
    rows: DataFrame, universe_id: str, universe_version: str, exchanges: Sequence[str], expected_date: Column,
    code: str = "etf_code", exchange: str = "exchange", date: str = "as_of_date",
) -> DataFrame:
    """(code, fault) of fund rows of another universe, exchange or date, and of repeated (code, date)."""
    from tidemark.fixed_values import SECURITY_CODE_PATTERN

    placed = F.coalesce(
        F.col(code).rlike(SECURITY_CODE_PATTERN)
        & F.col(exchange).isin(*exchanges)
        & (F.substring_index(code, ".", -1) == F.col(exchange)),
        F.lit(False),
    )
    dated = F.col(date).cast("string").try_cast("date")
    checks = [
        (~F.col("universe_id").eqNullSafe(F.lit(universe_id)), "universe_id_mismatch"),
        (~F.col("universe_version").eqNullSafe(F.lit(universe_version)), "universe_version_mismatch"),
        (~placed, "invalid_code_or_exchange"),
        (dated.isNull(), "invalid_date"),
        (dated != expected_date, "date_mismatch"),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in checks]))
    each = rows.select(F.col(code).alias("code"), F.explode(found).alias("fault"))
    repeated = rows.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("code"), F.col(date)).count().where("count > 1")
    return each.unionByName(repeated.select("code", F.lit("repeated_code_and_date").alias("fault")))
