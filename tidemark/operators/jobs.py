"""Collection jobs: binding snapshots to jobs, status, import assessment, work discovery."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.fixed_values import QUARANTINE_ERRORS, RETURNED_CODE_FIELD
from tidemark.functions.text import digest_id
from tidemark.session import settle


def bind_snapshots(snapshots: DataFrame, jobs: DataFrame) -> DataFrame:
    """Snapshots with the job they belong to.

    A snapshot that names its job binds by (job_id, request_version). One that does not
    binds by its query, to version 1 jobs only, where the query is the job's or an alias.
    """
    named = snapshots.where(F.col("job_id").isNotNull()).withColumn(
        "request_version", F.coalesce(F.col("request_version"), F.lit(1))
    )
    by_id = named.join(jobs.select("job_id", "request_version"), ["job_id", "request_version"], "left_semi")
    aliases = (
        jobs.where(F.col("request_version") == 1)
        .select("job_id", "request_version", F.explode(F.array_distinct(F.concat(F.array("query"), F.coalesce("query_aliases", F.array().cast("array<string>"))))).alias("query"))
    )
    by_query = (
        snapshots.where(F.col("job_id").isNull()).drop("job_id", "request_version").join(aliases, "query")
    )
    return by_id.unionByName(by_query.select(*by_id.columns))


def unbound_snapshots(snapshots: DataFrame, jobs: DataFrame) -> DataFrame:
    """(job_id, fingerprint) of snapshots that name no job and ask what a later version of one asks.

    Only version 1 may bind by its query; for later versions such a snapshot lacks its identity.
    """
    none = F.array().cast("array<string>")
    asked = jobs.where(F.col("request_version") > 1).select(
        "job_id", F.explode(F.array_distinct(F.concat(F.array("query"), F.coalesce("query_aliases", none)))).alias("query")
    )
    loose = snapshots.where(F.col("job_id").isNull()).select("query", "fingerprint")
    return loose.join(asked, "query").select("job_id", "fingerprint")


def snapshot_summary(bound: DataFrame) -> DataFrame:
    """Snapshots and distinct fingerprints per job (historical or unbound sets)."""
    return bound.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("snapshot_count"), F.countDistinct("fingerprint").alias("fingerprint_count")
    )


def historical_snapshots(snapshots: DataFrame, jobs: DataFrame) -> DataFrame:
    """(job_id, fingerprint) of snapshots that answer what a job asked in an earlier version.

    ``jobs``: job_id, historical_queries array<struct<request_version, query>>. A snapshot that names its job must
    name the version with the query; one that names none is history of every job that once asked its query.
    Both are equi joins on the exploded history, which repeats nothing.
    """
    history = jobs.select("job_id", F.inline("historical_queries")).distinct()
    named = snapshots.where(F.col("job_id").isNotNull()).join(
        history, ["job_id", "request_version", "query"], "left_semi"
    )
    loose = snapshots.where(F.col("job_id").isNull()).select("query", "fingerprint")
    asked = history.select("job_id", "query").distinct()
    return named.select("job_id", "fingerprint").unionByName(loose.join(asked, "query").select("job_id", "fingerprint"))


def fingerprint(query: Column, names: Column, *evidence: Column) -> Column:
    """Digest of what a snapshot asked for and got, independent of its rows."""
    parts = [F.coalesce(query, F.lit("")), F.array_join(F.sort_array(names), ",")]
    return digest_id(parts + [F.array_join(e, ",") for e in evidence], 20)


def bundle_id(df: DataFrame, group: Sequence[str], version: Sequence[str], member: str) -> DataFrame:
    """Digest over the versions and the sorted distinct members of each bundle.

    Rows are partitioned by bundle and sorted by member, and a running SHA-256 takes one member after
    another, so a bundle of any number of members needs the memory of one Arrow batch. Null members are left out; a
    bundle of null members only is the digest of its versions and an empty member.
    """
    keys = list(group)
    held = df.select(*keys, F.col(member).cast("string").alias("__member"))
    ordered = held.groupBy(*keys, "__member").count().drop("count")  # repeats go before the shuffle
    ordered = ordered.repartition(*keys).sortWithinPartitions(*keys, "__member")
    schema = StructType([*[held.schema[k] for k in keys], StructField("bundle_id", StringType())])
    head = b"\0".join(v.encode() for v in version)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest, empty = None, None, True

        def closed() -> str:
            return (digest if not empty else _fed(digest, b"")).hexdigest()[:20]

        for batch in batches:
            rows, ids = [], []
            members = batch.column(len(keys)).to_pylist()
            for row, key in enumerate(zip(*[c.to_pylist() for c in batch.columns[: len(keys)]], strict=True)):
                if key != open_key or digest is None:
                    if digest is not None:
                        rows.append(open_key)
                        ids.append(closed())
                    open_key, digest, empty = key, hashlib.sha256(head), True
                if members[row] is not None:
                    _fed(digest, members[row].encode())
                    empty = False
            yield _bundles(batch.schema, keys, rows, ids)
        if digest is not None:
            yield _bundles(batch.schema, keys, [open_key], [closed()])

    return ordered.mapInArrow(fold, schema)


def _fed(digest, member: bytes):
    digest.update(b"\0" + member)
    return digest


def _bundles(schema: pa.Schema, keys: list[str], rows: list[tuple], ids: list[str]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(keys))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.string())], names=[*keys, "bundle_id"])


def job_status(
    jobs: DataFrame, snapshots: DataFrame, members: DataFrame, unbound: DataFrame | None = None
) -> DataFrame:
    """Status of every job: quarantined, complete, partial or not_started, with its errors.

    ``jobs``: job_id, minimum_expected_count. ``snapshots``: job_id, record_id, page,
    page_limit, total, returned, errors array<string>. ``members``: job_id, code, one row
    per returned security. ``unbound``: rows of :func:`unbound_snapshots`; a job that has any is
    quarantined, also when it has no snapshot of its own.
    """
    pages = snapshots.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.count("page").alias("__paged"),
        F.countDistinct("page").alias("present_page_count"),
        F.min("page").cast("long").alias("first_page"),
        F.max("page").cast("long").alias("last_page"),
        F.min("page_limit").cast("long").alias("__limit"),
        F.max("page_limit").cast("long").alias("__limit_hi"),
        F.min("total").cast("long").alias("__total"),
        F.max("total").cast("long").alias("__total_hi"),
        F.sum("returned").cast("long").alias("returned_row_count"),
    )
    errors = snapshots.select("job_id", F.explode("errors").alias("error")).groupBy("job_id").agg(
        F.collect_set("error").alias("snapshot_errors")
    )
    per_code = members.groupBy("job_id", "code").agg(F.count(F.lit(1)).alias("__n"))
    codes = per_code.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("unique_security_count"), F.sum("__n").alias("__codes")
    )
    joined = jobs.join(pages, "job_id", "left").join(errors, "job_id", "left").join(codes, "job_id", "left")
    if unbound is None:
        joined = joined.withColumn("__loose", F.lit(None).cast("long"))
    else:
        loose = unbound.groupBy("job_id").agg(F.count(F.lit(1)).alias("__loose"))
        joined = joined.join(loose, "job_id", "left")
    present = F.col("present_page_count")
    zero = F.lit(0).cast("long")
    unique, listed = F.coalesce("unique_security_count", zero), F.coalesce("__codes", zero)
    one_total, one_limit = F.col("__total") == F.col("__total_hi"), F.col("__limit") == F.col("__limit_hi")
    total, limit = F.when(one_total, F.col("__total")), F.when(one_limit, F.col("__limit"))
    expected = F.ceil(F.try_divide(total, limit)).cast("long")
    repeated = F.col("__paged") > present
    contiguous = (F.col("first_page") == 1) & (F.col("last_page") == present)
    full = F.coalesce(~repeated & contiguous & (present == expected), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(repeated, F.lit("duplicate_pages")),
            F.when(~one_total, F.lit("inconsistent_total")),
            F.when(~one_limit, F.lit("inconsistent_limit")),
            F.when(listed != unique, F.lit("duplicate_security_codes")),
            F.when(full & (F.col("returned_row_count") != total), F.lit("returned_count_mismatch")),
            F.when(full & (unique != total), F.lit("unique_security_count_mismatch")),
            F.when(F.col("__total") < F.col("minimum_expected_count"), F.lit("below_minimum_expected_count")),
            F.when(~contiguous, F.lit("non_contiguous_pages")),
            F.when(F.col("__loose") > 0, F.lit("collection_job_identity_missing")),
        )
    )
    none = F.array().cast("array<string>")
    all_errors = F.sort_array(F.array_distinct(F.concat(F.coalesce("snapshot_errors", none), found)))
    started = F.col("snapshot_count").isNotNull() | F.col("__loose").isNotNull()
    quarantined = F.arrays_overlap(all_errors, F.array(*[F.lit(e) for e in QUARANTINE_ERRORS]))
    status = (
        F.when(~started, F.lit("not_started"))
        .when(quarantined, F.lit("quarantined"))
        .when((F.size(all_errors) == 0) & full, F.lit("complete"))
        .otherwise(F.lit("partial"))
    )
    empty = F.col("snapshot_count").isNull() & (F.size(all_errors) == 0)
    next_page = F.when(empty, F.lit(1).cast("long")).when(
        (F.size(all_errors) == 0) & contiguous & ~full, present + 1
    )
    return joined.select(
        "job_id",
        status.alias("status"),
        F.coalesce("snapshot_count", zero).alias("snapshot_count"),
        F.coalesce(present, zero).alias("present_page_count"),
        total.alias("reported_total_count"),
        F.coalesce("returned_row_count", zero).alias("returned_row_count"),
        unique.alias("unique_security_count"),
        expected.alias("expected_page_count"),
        next_page.alias("next_page"),
        F.when(started, all_errors).otherwise(none).alias("errors"),
    )


def import_assessment(collections: DataFrame, responses: DataFrame, members: DataFrame) -> DataFrame:
    """``ready_to_normalize`` or ``quarantined_raw_only`` with the blocking reasons.

    The reasons are those found here and those given in ``contract_errors``; :func:`assess_collections`
    derives those from the contract, the plan and the rows.

    ``collections``: collection_id, job_known, version_matches, period_matches,
    query_matches, minimum_expected_count, contract_errors array<string>.
    ``responses``: collection_id, request_page, request_limit, code_count, returned,
    success, status_code. ``members``: collection_id, code.
    """
    from tidemark.operators.quality import provider_failure

    per = responses.groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("__responses"),
        F.count("request_page").alias("__requests"),
        F.countDistinct("request_page").alias("__pages"),
        F.min("request_page").cast("long").alias("__first"),
        F.max("request_page").cast("long").alias("__last"),
        F.min("request_limit").cast("long").alias("__limit"),
        F.max("request_limit").cast("long").alias("__limit_hi"),
        F.min(F.when(F.col("code_count") >= 0, F.col("code_count"))).cast("long").alias("__total"),
        F.max(F.when(F.col("code_count") >= 0, F.col("code_count"))).cast("long").alias("__total_hi"),
        F.count_if(F.coalesce(F.col("code_count") < 0, F.lit(True))).alias("__bad_total"),
        F.count_if(F.col("returned").isNull()).alias("__no_rows"),
        F.sum("returned").cast("long").alias("__returned"),
        F.bool_or(provider_failure(F.col("success"), F.col("status_code"))).alias("__failed"),
    )
    per_code = members.groupBy("collection_id", "code").agg(F.count(F.lit(1)).alias("__n"))
    codes = per_code.groupBy("collection_id").agg(F.count(F.lit(1)).alias("__unique"), F.sum("__n").alias("__codes"))
    joined = collections.join(per, "collection_id", "left").join(codes, "collection_id", "left")
    zero = F.lit(0).cast("long")
    unique, listed = F.coalesce("__unique", zero), F.coalesce("__codes", zero)
    one_total, one_limit = F.col("__total") == F.col("__total_hi"), F.col("__limit") == F.col("__limit_hi")
    total, limit = F.when(one_total, F.col("__total")), F.when(one_limit, F.col("__limit"))
    expected = F.greatest(F.lit(1).cast("long"), F.ceil(F.try_divide(total, limit)).cast("long"))
    assessed = total.isNotNull() & limit.isNotNull()
    whole = (F.col("__first") == 1) & (F.col("__last") == expected) & (F.col("__pages") == expected) & (F.col("__requests") == expected)
    checks = [
        (~F.col("job_known"), "financial_job_unknown"),
        (F.col("job_known") & ~F.col("version_matches"), "financial_request_version_mismatch"),
        (F.col("job_known") & ~F.col("period_matches"), "financial_plan_period_mismatch"),
        (F.col("job_known") & ~F.col("query_matches"), "financial_plan_query_mismatch"),
        (F.col("__requests") < F.col("__responses"), "financial_request_pagination_missing"),
        (F.col("__failed"), "financial_provider_reported_failure"),
        (F.col("__bad_total") > 0, "financial_code_count_invalid"),
        (F.col("__no_rows") > 0, "financial_datas_missing"),
        (F.col("__requests") > F.col("__pages"), "financial_duplicate_request_pages"),
        (~one_limit, "financial_request_limit_inconsistent"),
        (~one_total, "financial_code_count_inconsistent"),
        (listed != unique, "financial_duplicate_security_codes"),
        (F.col("__total") < F.col("minimum_expected_count"), "financial_below_minimum_expected_count"),
        (assessed & ~whole, "financial_request_pages_incomplete"),
        (assessed & (F.coalesce("__returned", zero) != total), "financial_returned_count_incomplete"),
        (assessed & (unique != total), "financial_unique_security_count_mismatch"),
        (assessed & (total == 0), "financial_empty_result"),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in checks]))
    reasons = F.sort_array(
        F.array_distinct(F.concat(found, F.coalesce("contract_errors", F.array().cast("array<string>"))))
    )
    return joined.select(
        "collection_id",
        F.when(F.size(reasons) > 0, F.lit("quarantined_raw_only")).otherwise(F.lit("ready_to_normalize")).alias("status"),
        reasons.alias("blocked_reasons"),
        total.alias("reported_total_count"),
        F.coalesce("__returned", zero).alias("returned_row_count"),
        unique.alias("unique_security_count"),
        F.when(assessed, expected).alias("expected_page_count"),
    )


def assess_collections(
    collections: DataFrame, plan: DataFrame | None, responses: DataFrame, rows: DataFrame, code: str = RETURNED_CODE_FIELD
) -> DataFrame:
    """:func:`import_assessment` with every reason derived from the contract, the plan and the returned rows.

    ``collections``: collection_id, query, job_id, request_version, expected_period_end, query_sha256 (null without
    a job contract) and the period sets financial_periods, label_periods, filing_periods.
    ``plan``: job_id, request_version, period_end, query, minimum_expected_count, one row for each job, or None where
    there is no plan. ``rows``: collection_id and the returned row as variant.
    """
    contracted = F.col("job_id").isNotNull()
    if plan is None:
        schema = "__job string, __version int, __period string, __query string, minimum_expected_count int"
        planned = collections.sparkSession.createDataFrame([], schema)
    else:
        planned = plan.select(
            F.col("job_id").alias("__job"), F.col("request_version").alias("__version"), F.col("period_end").alias("__period"),
            F.col("query").alias("__query"), "minimum_expected_count",
        )
    shape = F.schema_of_variant("row")
    read = F.trim(F.when(F.schema_of_variant(F.try_variant_get("row", f"$['{code}']", "variant")) == "STRING", F.try_variant_get("row", f"$['{code}']", "string")))
    marked = rows.select(
        "collection_id",
        F.coalesce(shape.startswith("OBJECT"), F.lit(False)).alias("__object"),
        F.when(read != "", read).alias("code"),
    )
    faulty = marked.groupBy("collection_id").agg(
        F.bool_or(~F.col("__object")).alias("__invalid"),
        F.bool_or(F.col("__object") & F.col("code").isNull()).alias("__codeless"),
    )
    members = marked.where(F.col("code").isNotNull()).select("collection_id", "code")
    joined = collections.join(planned, F.col("job_id") == F.col("__job"), "left").join(faulty, "collection_id", "left")
    known = F.col("__job").isNotNull()
    only = F.array("expected_period_end")
    dated = contracted & F.col("expected_period_end").isNotNull()
    errors = [
        (~contracted, "financial_job_contract_missing"),
        (contracted & F.lit(plan is None), "financial_plan_missing"),
        (known & ~F.sha2("__query", 256).eqNullSafe(F.col("query_sha256")), "financial_plan_query_hash_mismatch"),
        (F.col("__invalid"), "financial_row_invalid"),
        (F.col("__codeless"), "financial_security_code_missing"),
        (dated & (F.col("financial_periods") != only), "financial_period_mismatch"),
        (dated & (F.col("label_periods") != only), "financial_report_period_label_mismatch"),
        (dated & (F.col("filing_periods") != only), "financial_filing_date_period_mismatch"),
    ]
    assessed = joined.select(
        "collection_id",
        # What cannot be looked up, as there is no contract or no plan, is no unknown job.
        (known | ~contracted | F.lit(plan is None)).alias("job_known"),
        F.coalesce(F.col("__version") == F.col("request_version"), ~known).alias("version_matches"),
        F.coalesce(F.col("__period") == F.col("expected_period_end"), ~known).alias("period_matches"),
        F.coalesce(F.col("__query") == F.col("query"), ~known).alias("query_matches"),
        "minimum_expected_count",
        F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in errors])).alias("contract_errors"),
    )
    return import_assessment(assessed, responses, members)


def pending_work(expected: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected work that has no output yet."""
    return expected.join(done, list(on), "left_anti")


def work_status(expected: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    held = done.select(*on).distinct().withColumn("__done", F.lit(True))
    return expected.join(held, list(on), "left").select(
        *expected.columns,
        F.when(F.col("__done"), F.lit("up_to_date")).otherwise(F.lit("planned")).alias("work_status"),
    )


def new_snapshots(incoming: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Incoming snapshots not stored yet; nulls equal nulls in the comparison."""
    held = existing.select(*[F.col(c).alias(f"__{c}") for c in on])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return incoming.join(held, condition, "left_anti")


def route_texts(texts: DataFrame, rules: DataFrame, text: str) -> DataFrame:
    """``texts`` with route and route_error: the exact rule first, else the only rule whose prefix begins the text.

    ``rules``: kind (``exact`` or ``prefix``), rule, route; a table of any size. A text is looked up under its
    beginnings of the lengths that rules have, so the join is one of equal values and the work does not
    grow with the number of rules. Several prefixes that match are an error, as are repeated rules;
    a null text has no route.
    """
    row = "__row"
    numbered = settle(texts.withColumn(row, F.monotonically_increasing_id()))
    lengths = rules.where("kind = 'prefix'").agg(F.sort_array(F.collect_set(F.length("rule"))).alias("__lengths"))
    fitting = F.filter("__lengths", lambda n: n <= F.length(text))
    begins = F.transform(fitting, lambda n: F.struct(F.lit("prefix").alias("kind"), F.left(F.col(text), n).alias("rule")))
    whole = F.array(F.struct(F.lit("exact").alias("kind"), F.col(text).alias("rule")))
    asked = numbered.where(F.col(text).isNotNull()).crossJoin(F.broadcast(lengths))  # one row: a set of lengths
    asked = asked.select(row, F.inline(F.concat(whole, begins)))
    hits = asked.join(rules.select("kind", "rule", "route"), ["kind", "rule"]).groupBy(row).agg(
        F.count_if(F.col("kind") == "exact").alias("__exact"),
        F.count_if(F.col("kind") == "prefix").alias("__prefixes"),
        F.min(F.when(F.col("kind") == "exact", F.col("route"))).alias("__by_exact"),
        F.min(F.when(F.col("kind") == "prefix", F.col("route"))).alias("__by_prefix"),
    )
    error = (
        F.when(F.col("__exact") > 1, F.lit("matches_repeated_rules"))
        .when((F.coalesce("__exact", F.lit(0)) == 0) & (F.col("__prefixes") > 1), F.lit("matches_multiple_prefixes"))
    )
    route = F.when(F.col("__exact") > 0, F.col("__by_exact")).otherwise(F.col("__by_prefix"))
    return numbered.join(hits, row, "left").select(
        *texts.columns, F.when(error.isNull(), route).alias("route"), error.alias("route_error")
    )


def repeated_rules(rules: DataFrame) -> DataFrame:
    """(kind, rule, copies) of rules that occur more than once."""
    return rules.groupBy("kind", "rule").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def latest_targets(screens: DataFrame, universe_id: str, priority: str = "P0") -> DataFrame:
    """Target securities of the newest screen bundle of a universe.

    ``screens``: bundle, universe_id, as_of_date, priority, security_code, security_name.
    """
    eligible = screens.where(F.col("universe_id") == universe_id)
    newest = eligible.agg(F.max(F.struct("as_of_date", "bundle")).alias("m")).select("m.as_of_date", "m.bundle")
    return eligible.join(F.broadcast(newest.limit(1)), ["as_of_date", "bundle"], "left_semi").where(
        (F.col("priority") == priority) & (F.coalesce("security_name", F.lit("")) != "")
    )


def target_batches(targets: DataFrame, size: int = 25, order: Sequence[str | Column] = ("security_code",)) -> DataFrame:
    """Ordered targets in batches of ``size``, with the batch's target text.

    The order is global, so the positions come from :func:`ranked`; a batch holds at most
    ``size`` names.
    """
    from tidemark.operators.ordering import ranked

    placed = ranked(targets, list(order), rank="__pos")
    batched = placed.withColumn("batch_number", F.floor((F.col("__pos") - 1) / size).cast("long") + 1)
    label = F.concat_ws(" ", "security_code", "security_name")
    grouped = batched.groupBy("batch_number").agg(
        F.count(F.lit(1)).alias("target_count"), F.sort_array(F.collect_list(F.struct("__pos", label.alias("label")))).alias("__items")
    )
    return grouped.select(
        "batch_number", "target_count", F.array_join(F.col("__items.label"), "、").alias("target_text")
    )
