"""Named queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle_sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the decorated function under its name, with the SQL that gives the same rows."""

        def add(function: Query) -> Query:
            name = function.__name__
            self.queries[name] = function
            if sql is not None:
                self.oracle_sql[name] = sql
            return function

        return add


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimal results as doubles, the one number type both sides print alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
