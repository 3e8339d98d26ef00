"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def full_address(address: Column, address2: Column) -> Column:
    """Both address lines with one space between; the space stays when line two is null."""
    return F.concat_ws("", address, F.lit(" "), F.coalesce(address2, F.lit("")))


def same_text(left: Column, right: Column) -> Column:
    """Equality that ignores case."""
    return F.upper(left) == F.upper(right)


def size_label(size: Column) -> Column:
    """Bytes as a label such as ``575 MB``.

    A unit is used up to 10,240 of it, and the figure is rounded to the nearest
    whole unit, so 8,192 stays in bytes and 602,415,104 becomes 575 MB.
    """
    label = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), start=1):
        half_units = F.shiftright(size, 10 * power - 1)
        rounded = F.shiftright(half_units + 1, 1).cast("string")
        below = 10 * 1024 if power == 1 else 10 * 1024**power - 1024 ** (power - 1) // 2
        label = F.when(size >= below, F.concat(rounded, F.lit(f" {unit}"))).otherwise(label)
    return label
