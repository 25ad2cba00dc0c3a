"""Joins whose physical form is left to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def join_checked(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """A join without hints: Spark broadcasts ``right`` only after it has measured its bytes at
    run time, and splits skewed partitions otherwise. No job runs while the plan is built."""
    return left.join(right, on if isinstance(on, (str, Column)) else list(on), how)
