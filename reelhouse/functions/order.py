"""Orders over whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tie_breakers(df: DataFrame, leading: list[str | Column]) -> list[Column]:
    """The columns not in ``leading`` that have an order."""
    named = {c for c in leading if isinstance(c, str)}
    return [F.col(f"`{c}`") for c, kind in df.dtypes if c not in named and "map<" not in kind and kind != "variant"]


def spread_by_range(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in ranges of ``order``; rows that are equal under it are spread by their place in the input."""
    place = F.monotonically_increasing_id()
    return df.withColumn("_place", place).repartitionByRange(*order, "_place").drop("_place")
