"""URL verdicts: rules first, then propagation over the link graph of hosts.

A url is judged by the longest rule that fits it. Where none fits, its host decides: trust
starts at hosts that rules allow and follows links; distrust starts at hosts that rules
block and follows links backwards, to those who link there. Both are personalised PageRank,
and a host is blocked when its distrust is larger than ``threshold`` times its trust.

Only DataFrame operations are used. Links are summed to one weighted row for each pair of
hosts before any iteration; one join and one sum carry both walks a step further, and every
few steps the ranks are written to the shared folder. The walks go on until no host is new
to either and no rank of a host changed by more than ``TOLERANCE`` of itself since they were
last written. That is the same number of steps however many seeds and hosts there are; only a chain of
hosts takes as many steps as it has links. A number of ``steps`` ends them there instead, with
ranks that may still change. A rank too small for a double is 0. What is kept for a host is two
numbers, so a host with a third of all pages is one row.

A null url, or one without ``://``, has an empty host and path and is judged like a host
without links (allow). Repeated rows are judged each; an empty table gives no rows; a
null ``html`` has no links; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: A rule: verdict, host, path. A list of rules is part of the query and compared one by one.
Rule = tuple[str, str, str]
#: Change of any rank over ``settle_every`` steps, as a share of it, at which they are settled.
TOLERANCE = 1e-6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link to another host inside a page; groups: scheme, host.
_LINK = r"""(?i)href\s*=\s*["']?([a-z][a-z0-9+.\-]*:)?//([^/?#"'<>\s]+)"""


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict); null where none fits."""
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def host_links(judged: DataFrame) -> DataFrame:
    """(source, target, weight): links between different hosts, one row for each pair."""
    return (
        judged.where("host <> ''")
        .select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(2))).alias("target"))
        .select(F.col("host").alias("source"), F.translate("target", _UPPER, _LOWER).alias("target"))
        .where("source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def _change(before: DataFrame, after: DataFrame) -> tuple[float, int]:
    """The largest change of a rank as a share of it, and how many ranks are new."""
    pairs = before.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d")).join(after, "host", "full")
    was_t, was_d, t, d = (F.coalesce(c, F.lit(0.0)) for c in ("t", "d", "trust", "distrust"))
    share = lambda now, was: F.when(now > 0, F.abs(now - was) / now).otherwise(0.0)
    row = pairs.agg(
        F.coalesce(F.max(F.greatest(share(t, was_t), share(d, was_d))), F.lit(0.0)).alias("change"),
        (F.count_if((t > 0) & (was_t == 0)) + F.count_if((d > 0) & (was_d == 0))).alias("new"),
    ).first()
    return row["change"], row["new"]


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float, steps: int | None, settle_every: int
) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` of the same columns: after ``steps`` steps, or settled if null."""
    both = links.select("source", "target", "weight", F.lit(True).alias("forward")).unionByName(
        links.select(
            F.col("target").alias("source"), F.col("source").alias("target"), "weight", F.lit(False).alias("forward")
        )
    )
    totals = both.groupBy("source", "forward").agg(F.sum("weight").alias("total"))
    edges = written(
        both.join(totals, ["source", "forward"]).select(
            "source", "target", "forward", (F.col("weight") / F.col("total")).alias("share")
        ),
        "host-edges",
    )
    if edges.isEmpty():
        return seeds
    start = seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    ranks = settled = seeds
    for step in count(1):
        moved = edges.join(ranks.withColumnRenamed("host", "source"), "source").select(
            F.col("target").alias("host"),
            (damping * F.when(F.col("forward"), F.col("trust") * F.col("share")).otherwise(0.0)).alias("trust"),
            (damping * F.when(~F.col("forward"), F.col("distrust") * F.col("share")).otherwise(0.0)).alias("distrust"),
        )
        ranks = (
            moved.unionByName(start)
            .groupBy("host")
            .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        )
        if step == steps:
            break
        if step % settle_every == 0:
            ranks = written(ranks, "host-ranks")
            if steps is None:
                change, new = _change(settled, ranks)
                if not new and change <= TOLERANCE:
                    break
                settled = ranks
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    threshold: float = 1.0,
    damping: float = 0.85,
    steps: int | None = 12,
    settle_every: int = 3,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust (0 if none reached it).

    ``steps``: null goes on until the ranks are settled, a number stops there.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    judged = (
        pages.select("page_id", after_scheme(url).alias("rest"), F.col("html").cast("string").alias("html"))
        .select("page_id", "html", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path"))
        .withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    )
    seeds = written(
        judged.where("host <> '' AND fit IS NOT NULL")
        .groupBy("host", F.col("fit.verdict").alias("verdict"))
        .agg(F.count("*").cast("double").alias("n"))
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0.0)).alias("allowed"),
            F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0.0)).alias("blocked"),
        )
        .select(
            "host",
            (F.col("allowed") / (F.col("allowed") + F.col("blocked"))).alias("trust"),
            (F.col("blocked") / (F.col("allowed") + F.col("blocked"))).alias("distrust"),
        ),
        "host-seeds",
    )
    ranks = propagate(seeds, host_links(judged), damping, steps, settle_every)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return (
        judged.drop("html")
        .join(ranks, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce(
                F.col("fit.verdict"), F.when(distrust > threshold * trust, F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            trust.alias("trust"),
            distrust.alias("distrust"),
        )
    )
