"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Every round hangs the larger neighbours of each node, then the smaller ones, on the
    smallest of all; edges never multiply, and rounds grow with the logarithm of the longest
    path. A round is written to the shared folder. Ends when every node has one parent
    and no parent has a parent.
    """
    links = written(
        edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .where("node <> root")
        .distinct(),
        "links",
    )
    while True:
        twice = links.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        if twice.isEmpty() and links.join(links.select(F.col("node").alias("root")), "root", "left_semi").isEmpty():
            return links
        both = links.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            links.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = written(
            small.select(F.col("v").alias("node"), F.col("m").alias("root"))
            .unionByName(least.select(F.col("u").alias("node"), F.col("m").alias("root")))
            .where("node <> root")
            .distinct(),
            "links",
        )
