"""A Merkle manifest of a dataset: leaves by row, a tree for each group, a tree over groups.

The hash H is the lowercase hex SHA-256 of its inputs one after another, digests as hex text.
A leaf is H of the row's columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value. In each group leaves ascend by key. While a level has several nodes, every ``fanout``
consecutive ones make a run (the last one may be shorter) and become their H. The groups'
roots, the null group first and the others bytewise, make a tree in the same way.

A level is one pass of window functions: lag and lead columns at the fixed offsets 1 to
``fanout`` - 1, masked by the slot in the run and the run's length, give each node its
siblings, and the rows of first children hash them to the parents, which are the next level.
Windows are partitioned by group and stretch of positions, so a group that holds every row is
still many small partitions. Positions come from a range partitioning. Levels are written to
the shared folder; paths are joined from the root down.

Rows with a null key are leaves before all others. Rows of one key are ordered by leaf, so
equal rows may trade places but no result changes; each row has its own place and proof. An empty
table gives no rows. Texts of any length are hashed whole. Other columns than the named ones play no part,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import written
from tidemark.operators.ordering import ranked

#: Children of a node, and runs whose nodes share a window partition.
FANOUT, STRETCH = 8, 512

_STEP = "array<struct<before:binary,after:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _hash(text: Column) -> Column:
    """SHA-256 of a text, in binary."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf_digest(*values: Column) -> Column:
    """The binary leaf of a row of these values."""
    texts = [v.cast("string") for v in values]
    return _hash(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (grp, pos, n, digest, ...) with the digests before and after each in its run."""
    pos, slot = F.col("pos"), F.col("pos") % fanout
    run = F.least(F.lit(fanout), F.col("n") - (pos - slot))
    window = Window.partitionBy("grp", F.floor(pos / (fanout * STRETCH))).orderBy("pos")
    nothing = F.lit("").cast("binary")
    before = [F.when(slot >= j, F.lag("digest", j).over(window)).otherwise(nothing) for j in range(fanout - 1, 0, -1)]
    after = [F.when(slot + j < run, F.lead("digest", j).over(window)).otherwise(nothing) for j in range(1, fanout)]
    return nodes.withColumns({"before": F.concat(*before), "after": F.concat(*after)})


def _levels(nodes: DataFrame, most: int, fanout: int, name: str) -> list[DataFrame]:
    """Every level from ``nodes`` up to the one where each group has one node. ``most``: nodes of the largest group."""
    levels = []
    while most > 1:
        here = written(_siblings(nodes, fanout), f"{name}-{len(levels)}")
        levels.append(here)
        several = F.col("n") > 1
        nodes = here.where(F.col("pos") % fanout == 0).select(
            "grp",
            F.floor(F.col("pos") / fanout).alias("pos"),
            F.ceil(F.col("n") / fanout).alias("n"),
            F.when(several, _hash(_hex(F.concat("digest", "after")))).otherwise(F.col("digest")).alias("digest"),
        )
        most = -(-most // fanout)
    levels.append(written(nodes, f"{name}-{len(levels)}"))
    return levels


def _down(levels: list[DataFrame], tops: DataFrame, fanout: int, told: Sequence[str]) -> DataFrame:
    """The lowest level with each node's path to the root.

    ``tops``: grp, path and the columns ``told`` of each group's last node.
    """
    above = tops.withColumn("up", F.lit(0).cast("long"))
    for level in reversed(levels[:-1]):
        above = above.select(F.col("grp").alias("above_grp"), "up", F.col("path").alias("above"), *told)
        own = F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(F.array().cast(_STEP))
        joined = level.join(above, (F.col("grp") == F.col("above_grp")) & (F.floor(F.col("pos") / fanout) == F.col("up")))
        kept = [c for c in level.columns if c not in ("before", "after", "pos", *told)]
        above = joined.select(*kept, F.col("pos").alias("up"), F.concat(own, F.col("above")).alias("path"), *told)
    return above.withColumnRenamed("up", "pos")


def fold(digest: Column, path: Column) -> Column:
    """The root, in hex, that a node's binary digest and its path lead to."""
    up = lambda node, step: F.sha2(
        F.concat(_hex(step["before"]), node, _hex(step["after"])).cast("binary"), 256
    )
    return F.aggregate(path, _hex(digest), up)


def proof_digest(path: Column) -> Column:
    """H of the siblings, level by level to the root, left to right."""
    whole = F.aggregate(path, F.lit("").cast("binary"), lambda all_, s: F.concat(all_, s["before"], s["after"]))
    return F.sha2(_hex(whole).cast("binary"), 256)


def merkle_manifest(
    rows: DataFrame,
    columns: Sequence[str],
    key: str = "doc_id",
    group: str = "lang",
    carried: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row for each of ``rows``: key, grp, pos, n, digest (its leaf), path, subroot, root.

    Digests are binary; ``path`` has one (before, after) for each level, the tree of groups
    included. ``grp`` is empty for the null group and begins with ``=`` for others. ``carried``: more
    columns, computed from ``rows``, that come along; they must not be named like those above.
    """
    carried = dict(carried or {})
    leaves = written(
        rows.select(
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
            F.col(key).alias("key"),
            leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
            *[c.alias(name) for name, c in carried.items()],
        ),
        "merkle-leaves",
    )
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]
    numbered = leaves.withColumn("row", F.monotonically_increasing_id())
    nodes = ranked(numbered, order, by=["grp"], rank="pos", size="n").drop("row").withColumn("pos", F.col("pos") - 1)
    sizes = written(leaves.groupBy("grp").agg(F.count("*").alias("n")), "merkle-groups")
    most, groups = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    levels = _levels(nodes, most, fanout, "merkle-level")

    subroots = levels[-1].select(F.col("grp").alias("key"), F.lit("").alias("grp"), "digest")
    upper = ranked(subroots, [F.col("key").asc()], rank="pos").withColumn("pos", F.col("pos") - 1)
    upper = _levels(upper.withColumn("n", F.lit(groups).cast("long")), groups, fanout, "merkle-upper")
    root = upper[-1].select("grp", F.array().cast(_STEP).alias("path"), F.col("digest").alias("root"))
    tops = _down(upper, root, fanout, ["root"])
    if len(upper) == 1:  # one group: its root is the root
        tops = tops.join(upper[0].select("grp", "key", "digest"), "grp")
    tops = tops.select(F.col("key").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    found = _down(levels, tops, fanout, ["subroot", "root"])
    if len(levels) == 1:  # every group is one leaf
        found = levels[0].join(tops, "grp")
    return found.select(
        F.col("key").alias(key), "grp", "pos", "n", "digest", "path", "subroot", "root", *carried
    )
