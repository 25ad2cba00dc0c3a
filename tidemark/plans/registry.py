"""Registered queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(builder: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = builder
        if sql is not None:
            ORACLES[name] = sql
        return builder

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
