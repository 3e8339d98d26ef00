"""Joins whose left side may hold one key very many times."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def hot_join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows``, which may repeat a key without limit, with ``lookup``, which holds each key once.

    Adaptive execution splits a hot key over many tasks only when both inputs were
    shuffled for this very join. A lookup that comes out of an aggregate on the same
    columns is partitioned already, which would rule that out; with the key wrapped in
    a struct both sides get their own shuffle. Only the struct goes through it, and the key
    columns are taken out of it again afterwards. The lookup side is small by comparison,
    as it has one row per key. A null in the key matches nothing.
    """
    others = [c for c in lookup.columns if c not in on]
    key = F.struct(*[F.col(c) for c in on]).alias("_key")
    keyed = lookup.dropna(subset=on).select(key, *others)
    joined = rows.select(key, *[c for c in rows.columns if c not in on]).join(keyed, "_key", how)
    mine = [F.col("_key").getField(c).alias(c) if c in on else F.col(c) for c in rows.columns]
    return joined.select(*mine, *(others if how not in ("left_semi", "left_anti") else []))


def in_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose ``on`` columns appear in ``keys``."""
    return hot_join(rows, keys.select(*on).distinct(), on, "left_semi")


def not_in_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose ``on`` columns do not appear in ``keys``; a null in them never does."""
    return hot_join(rows, keys.select(*on).distinct(), on, "left_anti")
