"""Aggregated lists and latest-change lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.order import spread_by_range
from reelhouse.sources.session import stored


def group_concat(
    df: DataFrame,
    keys: list[str],
    value: str,
    name: str = "items",
    separator: str = ", ",
    distinct: bool = True,
    in_pieces: bool = False,
) -> DataFrame:
    """One sorted, separated list of ``value`` per group.

    Repeats are removed before the lists are built, so a task holds no more of a group
    than the list it returns. Where a group may be very large, ``in_pieces`` sorts it in
    many tasks: rows are stored in ranges of group and value, the part of a group in each
    range becomes a piece, and the pieces are joined in the order of the ranges. Then only
    pieces, not values, of a group meet in one task.
    """
    rows = df.select(*keys, value)
    if distinct:
        rows = rows.distinct()
    if not in_pieces:
        return rows.groupBy(*keys).agg(_sorted_list(value, value, separator).alias(name))
    ranged = spread_by_range(rows, [F.col(f"`{c}`") for c in [*keys, value]])
    # Stored, so that every reader sees the same ranges even after executors were lost.
    ranged = stored(ranged.withColumn("_piece", F.spark_partition_id()))
    pieces = ranged.groupBy(*keys, "_piece").agg(_sorted_list(value, value, separator).alias("_list"))
    return pieces.groupBy(*keys).agg(_sorted_list("_list", "_piece", separator).alias(name))


def _sorted_list(value: str, order: str, separator: str) -> Column:
    return F.expr(f"listagg(`{value}`, {_quoted(separator)}) WITHIN GROUP (ORDER BY `{order}`)")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def film_actor_lists(t: Mapping[str, DataFrame], separator: str = ", ") -> DataFrame:
    """The actors of each film as one list of full names; two actors of one name are both in it."""
    actors = t["actor"].select("actor_id", F.concat_ws(" ", "first_name", "last_name").alias("actor"))
    cast = t["film_actor"].select("actor_id", "film_id").distinct().join(actors, "actor_id")
    lists = group_concat(cast, ["film_id"], "actor", name="actors", separator=separator, distinct=False)
    return t["film"].select("film_id", "title").join(lists, "film_id").select("film_id", "title", "actors")


def last_updated(df: DataFrame, by: list[str] | None = None, column: str = "last_update") -> DataFrame:
    """Latest change of the whole record set, or of each group of it."""
    return df.groupBy(*(by or [])).agg(F.max(column).alias("last_updated"))
