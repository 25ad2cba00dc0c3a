"""Serving marts: market queue, company index and detail, content, periods, provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.detect import DETECTORS
from tidemark.functions.names import publish_columns
from tidemark.functions.text import public_url, shard_of
from tidemark.operators.coverage import domain_status
from tidemark.operators.ordering import ranked
from tidemark.operators.versions import merge_duplicates


def market_mart(screen: DataFrame) -> DataFrame:
    """Published queue rows with their shard."""
    return publish_columns(screen, fixed.MARKET_COLUMNS).withColumn("shard", shard_of(F.col("securityCode")))


def shard_counts(df: DataFrame, shard: str = "shard") -> DataFrame:
    return df.groupBy(shard).agg(F.count(F.lit(1)).alias("record_count"))


def child_counts(child: DataFrame, key: str, name: str) -> DataFrame:
    return child.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def company_index(companies: DataFrame, children: dict[str, DataFrame], key: str = "security_code") -> DataFrame:
    """One row per company with the number of rows in each child table.

    Each child is counted before the join, so no child row meets another child's rows.
    """
    out = companies
    for name, child in children.items():
        out = out.join(child_counts(child, key, f"{name}_count"), key, "left")
    return out.select(
        *companies.columns,
        *[F.coalesce(f"{n}_count", F.lit(0).cast("long")).alias(f"{n}_count") for n in children],
        shard_of(F.col(key)).alias("detail_shard"),
    )


def company_detail(
    companies: DataFrame,
    children: dict[str, tuple[DataFrame, Sequence[str], Sequence[str]]],
    key: str = "security_code",
    chunk: int = 1000,
) -> DataFrame:
    """Child rows of each company in chunks of at most ``chunk`` ordered items.

    ``children``: name -> (table, item columns, order columns ending in a unique one). A
    company may own a third of a child table, so its items are split over numbered chunks
    instead of being gathered in one array: all rows are kept, none grows without bound.
    """
    frames = []
    for name, (child, items, order) in children.items():
        owned = child.join(companies.select(key), key, "left_semi")
        placed = ranked(owned.select(key, *dict.fromkeys([*items, *order])), list(order), by=[key], rank="__pos")
        placed = placed.withColumn("chunk", F.floor((F.col("__pos") - 1) / chunk).cast("long"))
        packed = F.to_json(F.struct(*items))
        frames.append(
            placed.groupBy(key, "chunk")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("__pos"), packed.alias("item")))).alias("__items"))
            .select(key, F.lit(name).alias("child"), "chunk", F.col("__items.item").alias("items"))
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("detail_shard", shard_of(F.col(key)))


def publication_gate(records: DataFrame, key: str, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """(publishable records, rejected keys with reasons).

    A url, where there is one, must be absolute http or https to a public host without user info,
    and no text of the record may hold what a sensitive-data detector knows.
    """
    texts = [c for c, kind in records.dtypes if kind == "string" and c != key]
    joined = F.concat_ws("\n", *[F.col(c) for c in texts])
    reasons = [F.when(F.col(url).isNotNull() & ~public_url(F.col(url)), F.lit("url_not_public"))] if url in texts else []
    reasons += [F.when(F.coalesce(found(joined), F.lit(False)), F.lit(name)) for name, found in DETECTORS.items()]
    marked = records.withColumn("reject_reasons", F.array_compact(F.array(*reasons)))
    return (
        marked.where(F.size("reject_reasons") == 0).drop("reject_reasons"),
        marked.where(F.size("reject_reasons") > 0).select(key, "reject_reasons"),
    )


def content_mart(
    news: DataFrame, events: DataFrame, reports: DataFrame | None = None, sources: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Deduplicated news and events that may be published with the reports, what blocks the rest, and the status
    of each domain and of all of them together.

    News summaries may differ between copies; for events any difference is a conflict. ``reports``: rows of
    :func:`~tidemark.operators.content.document_rows`. ``sources``: (domain, source) of the bundles that were read;
    where it is absent, a domain with records has a source.
    """
    public_news, news_conflicts = merge_duplicates(publish_columns(news, fixed.CONTENT_COLUMNS), "newsId", ["summary"])
    public_events, event_conflicts = merge_duplicates(publish_columns(events, fixed.CONTENT_COLUMNS), "eventId")
    safe_news, rejected_news = publication_gate(public_news, "newsId")
    safe_events, rejected_events = publication_gate(public_events, "eventId")
    parts = {"news": (safe_news, "publishedAt"), "events": (safe_events, "publishedAt")}
    if reports is not None:
        parts["reports"] = (reports, "date")
    out = {
        "news": safe_news,
        "events": safe_events,
        "news_conflicts": news_conflicts,
        "event_conflicts": event_conflicts,
        "news_rejected": rejected_news,
        "event_rejected": rejected_events,
        "domains": domain_statuses(parts, sources),
    }
    return out if reports is None else out | {"reports": reports}


def domain_statuses(parts: dict[str, tuple[DataFrame, str]], sources: DataFrame | None = None) -> DataFrame:
    """(domain, status, source_count, record_count, as_of_date) of each part, and a row ``content`` for all.

    ``parts``: domain -> (records, date column). One aggregation over the parts; no count goes through the driver.
    """
    told = [
        df.select(F.lit(name).alias("domain"), F.lit(1).alias("n"), F.nullif(F.left(F.col(day).cast("string"), F.lit(10)), F.lit("")).alias("day"))
        for name, (df, day) in parts.items()
    ]
    records = told[0]
    for part in told[1:]:
        records = records.unionByName(part)
    names = records.sparkSession.createDataFrame([(n,) for n in parts], "domain string")
    counted = names.join(records.groupBy("domain").agg(F.sum("n").alias("record_count"), F.max("day").alias("as_of_date")), "domain", "left")
    if sources is None:
        counted = counted.withColumn("source_count", F.when(F.col("record_count") > 0, 1))
    else:
        bundles = sources.groupBy("domain").agg(F.countDistinct("source").alias("source_count"))
        counted = counted.join(bundles, "domain", "left")
    zero = F.lit(0).cast("long")
    counted = counted.select(
        "domain", F.coalesce("source_count", zero).cast("long").alias("source_count"), F.coalesce("record_count", zero).cast("long").alias("record_count"), "as_of_date"
    )
    whole = counted.agg(F.sum("source_count").alias("source_count"), F.sum("record_count").alias("record_count"), F.max("as_of_date").alias("as_of_date"))
    both = counted.unionByName(whole.withColumn("domain", F.lit("content")))
    return both.withColumn("status", domain_status(F.col("source_count"), F.col("record_count")))


def period_mart(facts: DataFrame, metrics: DataFrame, reports: DataFrame, keys: Sequence[str] = ("security_code", "period_end")) -> DataFrame:
    """Per (security, period): report label and filing date, facts map and metrics map.

    Of several fetches the newest counts (by ``fetched_at``; of one instant, the largest row).
    A report has tens of fields, so its maps are bounded by the configured mapping.
    """
    keys = list(keys)

    def as_map(df: DataFrame, name: str, value: Column, out: str) -> DataFrame:
        one = df.groupBy(*keys, F.col(name).alias("key")).agg(
            F.max(F.struct(F.col("fetched_at"), value.alias("value")))["value"].alias("value")
        )
        entries = F.sort_array(F.collect_list(F.struct("key", "value")))
        return one.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))

    fact_maps = as_map(facts, "canonical_field_name", F.when(F.col("value_status") == "present", F.col("value")), "facts")
    metric_maps = as_map(metrics, "metric_name", F.when(F.col("calculation_status") == "calculated", F.col("value")), "metrics")
    described = F.struct("fetched_at", "report_type", "report_period_label", "filing_date")
    meta = reports.groupBy(*keys).agg(F.max(described).alias("__newest")).select(
        *keys, "__newest.report_type", "__newest.report_period_label", "__newest.filing_date"
    )
    return fact_maps.join(metric_maps, keys, "full").join(meta, keys, "left")


def security_periods(periods: DataFrame, key: str = "security_code", period: str = "period_end") -> DataFrame:
    """Per security its periods in order; a security has one entry per reporting period."""
    rest = [c for c in periods.columns if c not in (key, period)]
    entries = F.sort_array(F.collect_list(F.struct(F.col(period), F.to_json(F.struct(*rest)).alias("document"))))
    return periods.groupBy(key).agg(entries.alias("periods"))


def dataset_summary(domains: dict[str, tuple[DataFrame, DataFrame, Column | None]]) -> DataFrame:
    """Status, record count and newest date per domain.

    ``domains``: name -> (source bundles, records, date expression over the records).
    """
    frames = []
    for name, (sources, records, day) in domains.items():
        source_count = sources.agg(F.count(F.lit(1)).alias("n")).scalar()
        newest = F.max(day) if day is not None else F.lit(None).cast("string")
        totals = records.agg(F.count(F.lit(1)).alias("record_count"), newest.alias("as_of_date"))
        frames.append(
            totals.select(
                F.lit(name).alias("domain"),
                domain_status(source_count, F.col("record_count")).alias("status"),
                "record_count",
                "as_of_date",
            )
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def page_rows(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
