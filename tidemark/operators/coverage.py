"""Coverage KPIs, status ladders and best-bundle selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coerce import code_base, version_key
from tidemark.functions.text import url_host
from tidemark.operators.joins import join_checked
from tidemark.operators.versions import latest_by


def search_coverage(items: DataFrame, tasks: DataFrame, targets: DataFrame) -> DataFrame:
    """KPIs of search results per task.

    ``items``: task_id, item_id, publisher, url, published_at, codes array<string>.
    ``tasks``: task_id, requested_size, reported_total, scope_type.
    ``targets``: task_id, security_code. Distinct counts are exact; lists of publishers
    and hosts, which may be long, are in :func:`seen_sources`.
    """
    base = items.select(
        "task_id",
        "item_id",
        "publisher",
        url_host(F.col("url")).alias("host"),
        "published_at",
        F.explode_outer(F.when(F.size("codes") > 0, F.col("codes"))).alias("code"),
    )
    wanted = targets.select("task_id", code_base(F.col("security_code")).alias("__base"), F.lit(True).alias("__hit")).distinct()
    matched = join_checked(
        base.withColumn("__base", code_base(F.col("code"))), wanted, ["task_id", "__base"], "left"
    )
    per_item = matched.groupBy("task_id", "item_id").agg(
        F.max("publisher").alias("publisher"),
        F.max("host").alias("host"),
        F.max("published_at").alias("published_at"),
        F.count("code").alias("named"),
        F.count("__hit").alias("hits"),
    )
    counted = per_item.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("returned_count"),
        F.countDistinct("publisher").alias("publisher_count"),
        F.countDistinct("host").alias("domain_count"),
        F.min("published_at").alias("published_at_min"),
        F.max("published_at").alias("published_at_max"),
        F.count_if(F.col("hits") > 0).alias("matched"),
        F.count_if((F.col("hits") == 0) & (F.col("named") > 0)).alias("off_scope"),
        F.count_if(F.col("named") == 0).alias("unidentified"),
    )
    joined = tasks.join(counted, "task_id", "left")
    scoped = F.col("scope_type") == "p0_securities"
    returned = F.coalesce(F.col("returned_count"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    return joined.select(
        "task_id",
        "scope_type",
        "requested_size",
        "reported_total",
        returned.alias("returned_count"),
        F.coalesce(F.col("reported_total") > returned, F.lit(False)).alias("truncated"),
        F.coalesce(returned >= F.least("requested_size", "reported_total"), F.lit(True)).alias("requested_size_honored"),
        F.coalesce("publisher_count", zero).alias("publisher_count"),
        F.coalesce("domain_count", zero).alias("domain_count"),
        "published_at_min",
        "published_at_max",
        *[
            F.when(scoped, F.coalesce(c, zero)).otherwise(zero).alias(f"{c}_items")
            for c in ("matched", "off_scope", "unidentified")
        ],
    )


def seen_sources(items: DataFrame) -> DataFrame:
    """Distinct publishers and hosts per task in long form, with their item counts."""
    seen = items.select(
        "task_id",
        F.inline(
            F.array(
                F.struct(F.lit("publisher").alias("kind"), F.col("publisher").alias("name")),
                F.struct(F.lit("domain").alias("kind"), url_host(F.col("url")).alias("name")),
            )
        ),
    )
    return seen.where(F.col("name").isNotNull()).groupBy("task_id", "kind", "name").agg(F.count(F.lit(1)).alias("items"))


def coverage_gaps(results: DataFrame) -> DataFrame:
    """One row per gap of a task; ``succeeded`` says whether the task ran."""
    scoped = F.col("scope_type") == "p0_securities"
    gaps = F.when(~F.col("succeeded"), F.array(F.lit("not_run"))).otherwise(
        F.array_compact(
            F.array(
                F.when(
                    F.col("truncated"),
                    F.format_string("truncated:%d/%d", "returned_count", "reported_total"),
                ),
                F.when(
                    scoped & (F.col("unidentified_items") > 0),
                    F.format_string("unidentified:%d", "unidentified_items"),
                ),
                F.when(
                    scoped & (F.col("returned_count") > 0) & (F.col("matched_items") == 0),
                    F.lit("no_target_found"),
                ),
            )
        )
    )
    return results.select("task_id", F.explode(gaps).alias("gap"))


def coverage_status(gaps: Column) -> Column:
    return F.when(gaps > 0, F.lit("insufficient")).otherwise(F.lit("reported_results_complete"))


def domain_status(sources: Column, records: Column) -> Column:
    return F.when(sources == 0, F.lit("missing")).when(records == 0, F.lit("empty")).otherwise(F.lit("ready"))


def overall_status(domains: DataFrame, status: str = "status") -> DataFrame:
    """``failed`` when any domain failed, ``ready`` when all are ready or empty, else ``partial``."""
    return domains.agg(
        F.when(F.bool_or(F.col(status) == "failed"), F.lit("failed"))
        .when(F.bool_and(F.col(status).isin("ready", "empty")), F.lit("ready"))
        .otherwise(F.lit("partial"))
        .alias("overall_status")
    )


def run_status(steps: DataFrame, runs: DataFrame) -> DataFrame:
    """Publication status of each run from its steps and its readiness.

    ``runs``: run_id, status, readiness_status, research_status, incomplete_job_count.
    """
    failed = steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("step_count"), F.bool_or(F.col("status") == "failed").alias("any_failed")
    )
    joined = runs.join(failed, "run_id", "left")
    ready = (
        (F.col("readiness_status") == "up_to_date")
        & (F.col("research_status") == "up_to_date")
        & (F.col("incomplete_job_count") == 0)
    )
    broken = ~F.col("status").eqNullSafe(F.lit("succeeded")) | F.coalesce("any_failed", F.lit(False))
    return joined.withColumn(
        "publication_status",
        F.when(broken, F.lit("failed")).when(F.coalesce(ready, F.lit(False)), F.lit("ready")).otherwise(F.lit("partial")),
    )


def latest_run(runs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The newest run by finish, else start, else path date."""
    moment = F.coalesce(F.col("finished_at"), F.col("started_at"), F.col("path_date").cast("timestamp"))
    return latest_by(
        runs.withColumn("__all", F.lit(1)), [*group, "__all"], [moment, F.coalesce("run_id", F.lit("")), "path"]
    ).drop("__all")


def best_bundle(counts: DataFrame, group: Sequence[str], bundle: str, count: str) -> DataFrame:
    """Per group the bundle with the greatest count; the greatest bundle id breaks ties."""
    return counts.groupBy(*group).agg(
        F.max_by(F.col(bundle), F.struct(F.col(count), F.col(bundle))).alias(bundle), F.max(count).alias(count)
    )


def best_version(manifests: DataFrame, group: Sequence[str], date: str, versions: Sequence[str], bundle: str) -> DataFrame:
    """Per group the manifest of the newest date; of equal dates that of the greatest versions, compared
    in their order, then that of the greatest bundle id.

    Only keys are compared and carried through the aggregation; the manifest is joined back by its bundle.
    """
    chosen = manifests.groupBy(*group).agg(
        F.max(F.struct(F.col(date), *[version_key(F.col(v)).alias(f"__{v}") for v in versions], F.col(bundle))).alias("__best")
    )
    chosen = chosen.select(*group, F.col(f"__best.{bundle}").alias(bundle))
    return manifests.join(chosen, [*group, bundle], "left_semi")


def period_gaps(best: DataFrame, required: DataFrame, period: str, count: str, minimum: int) -> DataFrame:
    """Required periods without a bundle of at least ``minimum`` securities."""
    return required.join(best.where(F.col(count) >= minimum), period, "left_anti")


def distinct_records(frames: Sequence[DataFrame], identity: str) -> DataFrame:
    """Exact number of logical records across reprocessed bundles.

    For whole-number ids, and bundles that come again and again, see :mod:`tidemark.operators.sets`.
    """
    merged = frames[0].select(identity)
    for frame in frames[1:]:
        merged = merged.unionByName(frame.select(identity))
    return merged.where(F.coalesce(F.col(identity).cast("string"), F.lit("")) != "").agg(
        F.countDistinct(identity).alias("record_count")
    )


def filled_counts(counts: DataFrame, names: Sequence[str], name: str, count: str) -> DataFrame:
    """Counts with a zero row for every configured name that did not occur."""
    wanted = counts.sparkSession.createDataFrame([(n,) for n in names], f"{name} string")
    return wanted.join(counts, name, "left").select(
        name, F.coalesce(F.col(count), F.lit(0).cast("long")).alias(count)
    )


def mapping_coverage(parsed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Mapped and unmapped field names of each snapshot."""
    return parsed.groupBy(*group).agg(
        F.count(F.lit(1)).alias("field_count"),
        F.count_if(F.col("mapping_status") == "mapped").alias("mapped_count"),
        F.count_if(F.col("mapping_status") == "unmapped").alias("unmapped_count"),
        F.count_if(F.col("parse_error").isNotNull()).alias("error_count"),
    )


def unmapped_fields(parsed: DataFrame, group: Sequence[str], name: str = "base_field_name") -> DataFrame:
    """(group, name, parts): the union over all parts of the field names without a mapping, in long form."""
    return (
        parsed.where(F.col("mapping_status") == "unmapped")
        .groupBy(*group, name)
        .agg(F.count(F.lit(1)).alias("parts"))
    )


def period_evidence(parsed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Periods named by financial fields, report labels and filing dates of each snapshot.

    The sets hold the distinct periods of one snapshot's columns, a few at most.
    """
    category, name, period = F.col("category"), F.col("canonical_field_name"), F.col("period_end")

    def periods(condition: Column) -> Column:
        return F.sort_array(F.collect_set(F.when(condition, period)))

    return parsed.groupBy(*group).agg(
        periods(category == "financial").alias("financial_periods"),
        periods((category == "financial_metadata") & (name == "report_period_label")).alias("label_periods"),
        periods((category == "financial_metadata") & (name == "filing_date")).alias("filing_periods"),
    )


def period_contract(evidence: DataFrame, expected: Column) -> DataFrame:
    """Which evidence sets are not exactly the expected period."""
    only = F.array(expected)
    return evidence.withColumn(
        "contract_errors",
        F.array_compact(
            F.array(
                F.when(F.col("financial_periods") != only, F.lit("unexpected_financial_period")),
                F.when(F.col("label_periods") != only, F.lit("missing_expected_report_period_label")),
                F.when(F.col("filing_periods") != only, F.lit("missing_expected_filing_date")),
            )
        ),
    )


def fact_coverage(facts: DataFrame, group: Sequence[str]) -> DataFrame:
    return facts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("fact_count"),
        F.count_if(F.col("value_status") == "present").alias("present_fact_count"),
        F.count_if(F.col("value_status") == "missing_in_source").alias("missing_fact_count"),
    )


def latest_stamp(stamps: DataFrame, text: str) -> DataFrame:
    """The newest timestamp text, compared as an instant, then as text."""
    moment = F.col(text).try_cast("timestamp")
    usable = stamps.where(moment.isNotNull())
    return usable.agg(F.max_by(F.col(text), F.struct(moment, F.col(text))).alias("generated_at"))
