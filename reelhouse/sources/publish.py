"""Writing tables.

Parquet tables take no UPDATE or DELETE, and a folder cannot be overwritten while it
is being read. A change is therefore a new table state: it is written beside the live
files first, and then the catalog entry is pointed at the new folder. Readers see the
old state or the new one, never a part of either.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.functions.order import spread_by_range, tie_breakers


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back; an existing folder is an error."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` in ranges of ``columns``, so that a filter on them skips files and row groups.

    The other columns take part in the ranges, and the place in the input after them: a
    value that fills a third of the table is spread over as many files as its rows need,
    even where the rows are wholly equal.
    """
    order = [F.col(f"`{c}`") for c in columns] + tie_breakers(df, columns)
    return spread_by_range(df, order).sortWithinPartitions(*columns)


def publish(
    spark: SparkSession,
    states: Mapping[str, DataFrame],
    root: str,
    batch: str,
    cluster_by: Mapping[str, list[str]] | None = None,
) -> dict[str, str]:
    """Make ``states`` the live content of the catalog tables they are keyed by.

    All states are written before the first table is switched, so a failed write
    leaves every table as it was; it is repeated under a new ``batch`` name. Tables
    in ``cluster_by`` are written in ranges of the columns given, such as the date
    that reports filter on. Returns the new folder of each table. Folders of earlier
    batches stay for readers that still hold them.
    """
    folders = {table: f"{root.rstrip('/')}/{table}/{batch}" for table in states}
    for table, df in states.items():
        columns = (cluster_by or {}).get(table)
        laid_out = clustered(df, columns) if columns else df
        laid_out.write.mode("errorifexists").parquet(folders[table])
    for table, df in states.items():
        if spark.catalog.tableExists(table):
            location = folders[table].replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=folders[table], source="parquet", schema=df.schema)
    return folders


def truncate_table(spark: SparkSession, table: str) -> None:
    """Remove all rows of a managed catalog table."""
    spark.sql(f"TRUNCATE TABLE {table}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
