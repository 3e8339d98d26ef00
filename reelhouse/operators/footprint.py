"""How much space tables take."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.functions import size_label


def _report(name: Column, files: Column, rows: Column, size: Column) -> list[Column]:
    return [name.alias("table_name"), files.alias("files"), rows.alias("row_count"), size.alias("table_bytes"), size_label(size).alias("table_size")]


def counted_in_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(row_count) of Parquet files, from the row counts in their footers.

    The count is pushed down to the reader, which Spark's newer Parquet source can; a
    session of its own selects that source, so that other reads are as they were.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(*paths).agg(F.count(F.lit(1)).alias("row_count"))


def files_footprint(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """Files, rows and bytes of Parquet files or folders, from their listing and their footers; no row is read.

    Built eagerly: the footers are counted when it is called.
    """
    if not paths:
        listed, rows = spark.createDataFrame([], "length bigint"), 0
    else:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths).select("length")
        rows = counted_in_footers(spark, paths).first()["row_count"]
    totals = listed.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return totals.select(*_report(F.lit(name), F.col("files"), F.lit(rows).cast("long"), F.col("bytes")))


def table_footprint(df: DataFrame, name: str) -> DataFrame:
    """Files, rows and bytes behind the rows of ``df``, which may be some rows of a table only.

    No column of the table is read. The rows are counted per file first, so that each
    file's size is added once. For whole tables :func:`files_footprint` reads less.
    """
    files = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    totals = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("table_bytes"),
    )
    return totals.select(*_report(F.lit(name), F.col("files"), F.col("row_count"), F.col("table_bytes")))


def footprints(t: Mapping[str, DataFrame], name_like: str | None = None) -> DataFrame:
    """Footprints of all tables, or of those whose name matches a LIKE pattern.

    Tables that know their path, as those of a catalog do, are counted by their footers.
    """
    path = getattr(t, "path", None)
    one = (lambda name: files_footprint(t[name].sparkSession, [path(name)], name)) if path else (lambda name: table_footprint(t[name], name))
    report = reduce(DataFrame.unionByName, [one(name) for name in t])
    return report if name_like is None else report.where(F.col("table_name").like(name_like))


def rewrite_footprint(spark: SparkSession, before: list[str], after: list[str]) -> DataFrame:
    """Files, rows and bytes before and after a change of a table, and of what is dead by it.

    Dead are files that the state before has and the one after has not.
    """
    left = set(after)
    parts = {"before": before, "after": after, "dead": [p for p in before if p not in left]}
    return reduce(DataFrame.unionByName, [files_footprint(spark, paths, name) for name, paths in parts.items()])
