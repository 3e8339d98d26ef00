"""Dense numbering and key assignment without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reelhouse.functions.order import spread_by_range, tie_breakers
from reelhouse.sources.session import checkpointed

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def number_rows(
    df: DataFrame, order_by: list[str | Column], name: str = "row_num", start: int = 1, unique: bool = False
) -> DataFrame:
    """Number the rows ``start, start + 1, …`` in the given order.

    The rows are range-partitioned and sorted, and each gets its place in its own
    partition plus the row count of the partitions before it. The remaining columns
    break ties and take part in the ranges, so many equal leading values do not end up
    in one partition and equal input gives equal numbers. Rows that are equal in every
    column are told apart by their place in the input, in the ranges only. Where the order
    is ``unique`` by itself both are left out, which keeps the sample and the sort narrow.

    The sorted rows are checkpointed: range bounds come from a sample, and the counts
    and the rows must see the same bounds even when an executor is lost in between.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    place = F.monotonically_increasing_id()
    if unique:
        ranged = df.repartitionByRange(*order)
    else:
        order += tie_breakers(df, order_by)
        ranged = spread_by_range(df, order)
    placed = checkpointed(
        ranged.sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(place, _INDEX_BITS))
        .withColumn("_index", place.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
    )
    # One row per partition, so both the un-partitioned window and the broadcast are
    # bounded by the number of shuffle partitions and not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_offset") + F.col("_index") + F.lit(start)).alias(name),
    )


def assign_keys(
    rows: DataFrame, target: DataFrame, key: str, order_by: list[str | Column], unique: bool = False
) -> DataFrame:
    """Give ``rows`` surrogate keys that continue after the largest one in ``target``."""
    last = target.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).scalar()
    numbered = number_rows(rows, order_by, name="_place", unique=unique)
    key_type = target.schema[key].dataType
    return numbered.withColumn(key, (last + F.col("_place")).cast(key_type)).drop("_place")
