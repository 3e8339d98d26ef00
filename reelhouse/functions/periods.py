"""Half-open calendar periods.

``EXTRACT(quarter FROM col) = EXTRACT(quarter FROM day)`` hides a range from the
parquet reader. Stated as ``start <= col < end`` with constant bounds it is pushed
into the scan and skips row groups, so every calendar filter here is written that way.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

Day = dt.date | str | None


def day_literal(day: Day) -> Column:
    """``day`` as a DATE constant; today when it is not given."""
    return F.current_date() if day is None else F.lit(day).cast("date")


def moment(at: dt.datetime | str) -> Column:
    """A point in time as a constant without a zone; a bare datetime would be read in the driver's zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def quarter_of(day: Day = None) -> tuple[Column, Column]:
    start = F.trunc(day_literal(day), "quarter")
    return start, F.add_months(start, 3)


def month_of(day: Day = None) -> tuple[Column, Column]:
    start = F.trunc(day_literal(day), "month")
    return start, F.add_months(start, 1)


def year_of(year: int) -> tuple[Column, Column]:
    return F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year + 1, 1, 1))


def within(column: str | Column, period: tuple[Column, Column]) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    start, end = period
    return (col >= start) & (col < end)
