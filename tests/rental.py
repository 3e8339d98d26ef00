"""Small rental tables built from inline rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from reelhouse.sources.schemas import RENTAL


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def table(spark, name: str, columns: str, rows: list[tuple]):
    """Rows of a rental table; columns that are not named are null."""
    names = columns.split()
    full = spark.createDataFrame([], RENTAL[name]).schema
    given = [dict(zip(names, row, strict=True)) for row in rows]
    values = [tuple(_fit(r.get(f.name), f.dataType.typeName()) for f in full.fields) for r in given]
    return spark.createDataFrame(values, full)


def _fit(value, kind: str):
    if value is None:
        return None
    if kind == "decimal":
        return Decimal(str(value))
    if kind == "timestamp_ntz":
        return ts(value)
    if kind == "date":
        return dt.date.fromisoformat(value)
    return value


def values(df) -> list[tuple]:
    """Rows in order, decimals as floats."""
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()]
