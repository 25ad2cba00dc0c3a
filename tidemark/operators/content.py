"""Announcements and news: keyword taxonomy, identity, scope, tables, feeds and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.coerce import code_base, epoch_instant, instant, listed_code, variant_instant, zone_text
from tidemark.functions.text import compact_text, content_id, is_json, opened_once, safe_url, semantic_key
from tidemark.operators.joins import join_checked
from tidemark.operators.versions import first_by, latest_by
from tidemark.session import settle

ITEM_SCHEMA = (
    "title string, summary string, url string, publish_time variant, "
    "extra struct<publish_source: string, real_publish_source: string>, "
    "stock_infos array<struct<code: string, name: string>>"
)


# --- taxonomy -----------------------------------------------------------------------
def keyword_hits(title: Column, keywords: Sequence[str]) -> Column:
    return F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: title.contains(k))


def classify(
    title: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = fixed.EVENT_RULES,
    default: str = fixed.DEFAULT_EVENT_TYPE,
) -> tuple[Column, Column]:
    """(event type, hit keywords): the first rule with any hit wins and keeps all its hits."""
    kind, words = F.lit(default), F.array().cast("array<string>")
    for name, keywords in reversed(list(rules)):
        hits = keyword_hits(title, keywords)
        kind = F.when(F.size(hits) > 0, F.lit(name)).otherwise(kind)
        words = F.when(F.size(hits) > 0, hits).otherwise(words)
    return kind, words


#: Levels of quoting that one round opens.
_LEVELS = 4


def open_texts(df: DataFrame, text: str, opened: str = "opened_text") -> DataFrame:
    """``df`` with all strings inside ``text``, which may be JSON that holds JSON, joined by blanks.

    A work list: each round opens a few levels of the texts that still hold JSON and settles
    them; what is open leaves the list, and the loop ends when nothing is left on it. There is no deepest
    level. A row keeps its strings in document order, so nothing is shuffled. A null text stays null.
    """
    parts, more = "__parts", "__more"
    work, done = df.withColumn(parts, F.array(F.trim(text))), []
    while True:
        for _ in range(_LEVELS):
            work = work.withColumn(parts, opened_once(F.col(parts)))
        # Whether a text still holds JSON is written beside it: it is parsed for that once a round.
        work = settle(work.withColumn(more, F.exists(parts, is_json)))
        done.append(work.where(~F.col(more)).drop(more))
        work = work.where(more).drop(more)
        if work.isEmpty():
            break
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn(opened, F.when(F.col(text).isNotNull(), F.array_join(parts, " "))).drop(parts)


def semantic_gate(
    df: DataFrame, text: str, required: Sequence[Sequence[str]], forbidden: Sequence[str] = (), status: str = "status"
) -> DataFrame:
    """``df`` with ``ok``, ``unverifiable`` or ``mismatch`` of its text against concept groups.

    Every group needs one of its aliases, and no forbidden concept may occur. Texts and
    aliases are compared on letters and digits only; JSON text is opened first, however often it is quoted. An empty
    text is unverifiable.
    """
    opened = "__opened"
    found = open_texts(df, text, opened).withColumn(opened, semantic_key(F.col(opened)))

    def said(alias: str) -> Column:
        wanted = semantic_key(F.lit(alias))
        return (wanted != "") & F.col(opened).contains(wanted)

    every, banned = F.lit(True), F.lit(False)
    for group in required:
        every = every & F.greatest(F.lit(False), *[said(alias) for alias in group], F.lit(False))
    for concept in forbidden:
        banned = banned | said(concept)
    verdict = (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("unverifiable"))
        .when(every & ~banned, F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return found.withColumn(status, verdict).drop(opened)


# --- identity and scope -------------------------------------------------------------
def single_security(infos: Column) -> tuple[Column, Column]:
    """(code, name) when the item names exactly one security, else nulls."""
    only = F.when(F.size(infos) == 1, infos[0])
    return F.nullif(only["code"], F.lit("")), F.nullif(only["name"], F.lit(""))


def publisher(extra: Column) -> Column:
    return F.coalesce(
        F.nullif(extra["real_publish_source"], F.lit("")), F.nullif(extra["publish_source"], F.lit(""))
    )


def scope_filter(
    items: DataFrame,
    targets: DataFrame | None,
    allowed_types: Sequence[str] | None = None,
    code: str = "source_security_code",
    kind: str = "event_type",
) -> DataFrame:
    """Market-wide scope (no targets) keeps all; otherwise type list and target codes apply.

    Codes are compared without their exchange suffix.
    """
    if targets is None:
        return items
    if allowed_types is not None:
        items = items.where(F.col(kind).isin(*allowed_types))
    wanted = targets.select(code_base(F.col("security_code")).alias("__base")).distinct()
    return join_checked(items, wanted, code_base(F.col(code)) == F.col("__base"), "left_semi")


# --- tables -------------------------------------------------------------------------
def content_table(
    items: DataFrame,
    source: str,
    id_column: str,
    rules: Sequence[tuple[str, Sequence[str]]] = fixed.EVENT_RULES,
    id_source: str | None = None,
    with_publisher: bool = False,
    position: Sequence[str] = ("fetched_at", "raw_record_id", "position"),
) -> tuple[DataFrame, DataFrame]:
    """(records, rejected items) of announcements or news.

    ``items`` has :data:`ITEM_SCHEMA` plus query, fetched_at, raw_record_id and position.
    Items without title, URL or publish time are rejected. The first item of an id stays.
    """
    kinds = {"variant": variant_instant, "string": instant}
    moment = kinds.get(dict(items.dtypes)["publish_time"], epoch_instant)(F.col("publish_time"))
    published = zone_text(moment)
    kind, words = classify(F.col("title"), rules)
    code, name = single_security(F.col("stock_infos"))
    marked = items.withColumn("published_at", published).withColumn(
        "reject_reason",
        F.when(F.coalesce(F.trim("title"), F.lit("")) == "", F.lit("title:required"))
        .when(F.coalesce(F.trim("url"), F.lit("")) == "", F.lit("url:required"))
        .when(F.col("published_at").isNull(), F.lit("publish_time:invalid")),
    )
    rejected = marked.where(F.col("reject_reason").isNotNull())
    columns = [
        content_id(id_source or source, F.col("url"), F.col("published_at"), F.col("title")).alias(id_column),
        F.lit(source).alias("source"),
        *([publisher(F.col("extra")).alias("publisher")] if with_publisher else []),
        "title",
        "summary",
        "url",
        "published_at",
        F.col("published_at").alias("available_from"),
        kind.alias("event_type"),
        words.alias("classification_keywords"),
        F.lit(None).cast("string").alias("security_code"),
        code.alias("source_security_code"),
        name.alias("security_name"),
        "query",
        "fetched_at",
        "raw_record_id",
        "position",
        F.lit(fixed.TAXONOMY_VERSION).alias("taxonomy_version"),
    ]
    accepted = marked.where(F.col("reject_reason").isNull()).select(*columns)
    return first_by(accepted, [id_column], list(position)), rejected


def latest_fetch(content: DataFrame, id_column: str) -> DataFrame:
    """One row per id over all batches: the newest fetch."""
    return latest_by(content, [id_column], ["fetched_at"])


def feed_order(content: DataFrame, date: str, id_column: str) -> DataFrame:
    return content.orderBy(F.col(date).desc_nulls_last(), F.col(id_column).desc())


def daily_counts(content: DataFrame, day: Column, kind: str = "event_type") -> DataFrame:
    return content.groupBy(day.alias("report_date"), F.col(kind)).agg(F.count(F.lit(1)).alias("record_count"))


def report_span(content: DataFrame, day: Column) -> DataFrame:
    """Rows and published / available span of each daily report."""
    return content.groupBy(day.alias("report_date")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("published_at").alias("published_at_min"),
        F.max("published_at").alias("published_at_max"),
        F.max("available_from").alias("available_from_max"),
    )


FEED_COLUMNS = [
    "id", "type", "title", "date", "source", "url", "summary", "security_code", "security_name", "tags",
]


def feed_rows(content: DataFrame, kind: str, id_column: str) -> DataFrame:
    """Announcements or news under the one schema of the feed."""
    fallback = F.concat_ws("|", F.col("title"), F.col("published_at"))
    identifier = F.coalesce(F.col(id_column).cast("string"), fallback)
    code = F.coalesce(F.col("security_code"), F.col("source_security_code")) if kind == "announcement" else F.col("security_code")
    source = F.coalesce(F.col("publisher"), F.col("source")) if "publisher" in content.columns else F.col("source")
    tags = F.array(F.coalesce(F.col("event_type"), F.lit(kind)))
    if kind == "announcement":
        tags = F.concat(tags, F.coalesce(F.col("classification_keywords"), F.array().cast("array<string>")))
    return content.select(
        F.concat(F.lit(f"{kind}-"), identifier).alias("id"),
        F.lit(kind).alias("type"),
        "title",
        F.coalesce(F.col("published_at"), F.col("available_from")).alias("date"),
        source.alias("source"),
        safe_url(F.col("url")).alias("url"),
        compact_text(F.col("summary")).alias("summary"),
        F.when(F.coalesce(code, F.lit("")) != "", listed_code(code)).alias("security_code"),
        "security_name",
        tags.alias("tags"),
    )


def document_rows(documents: DataFrame) -> DataFrame:
    """Markdown reports (path, text) under the schema of the feed."""
    from tidemark.functions.text import markdown_summary, markdown_title, path_date

    none = F.lit(None).cast("string")
    return documents.select(
        F.concat(F.lit("document-"), F.col("path")).alias("id"),
        F.lit("daily").alias("type"),
        markdown_title(F.col("text"), F.col("path")).alias("title"),
        F.coalesce(path_date(F.col("path")), F.lit("")).alias("date"),
        F.lit("repository").alias("source"),
        none.alias("url"),
        markdown_summary(F.col("text")).alias("summary"),
        none.alias("security_code"),
        none.alias("security_name"),
        F.array(F.lit("daily")).alias("tags"),
    )


def document_bodies(documents: DataFrame) -> DataFrame:
    """(id, body) of the reports of :func:`document_rows`: the whole text, without its title line."""
    text = F.regexp_replace(F.col("text"), r"\A(?:[ \t]*\r?\n)*#[ \t]+[^\n]*(?:\n|\z)", "")
    return documents.select(F.concat(F.lit("document-"), F.col("path")).alias("id"), F.trim(text).alias("body"))


def feed(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0].select(*FEED_COLUMNS)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*FEED_COLUMNS))
    return out


def by_name_then(df: DataFrame, first: Sequence[Column], name: str, collation: str = "zh") -> DataFrame:
    """Order with locale-aware names last."""
    return df.orderBy(*first, F.collate(F.col(name), collation).asc())


def related(content: DataFrame, companies: DataFrame) -> DataFrame:
    """Content of a company by code or by name: two equi joins, each pair once.

    ``companies`` holds one row per code. A name that several companies have is a match for
    each of them; adaptive execution splits the join of a name that much content has.
    """
    by_code = content.join(companies.select("security_code"), "security_code").select("security_code", "id")
    named = companies.where(F.coalesce(F.col("security_name"), F.lit("")) != "")
    by_name = content.drop("security_code").join(named.select("security_code", "security_name"), "security_name")
    return by_code.unionByName(by_name.select("security_code", "id")).distinct()


def content_coverage(content: DataFrame) -> DataFrame:
    return content.groupBy("type").agg(F.count(F.lit(1)).alias("record_count"))
