"""Tables kept as lists of files, so that a change writes only the files it touches.

A state of a table is a list of Parquet files by name. A change finds the files that hold
rows it concerns, writes those anew, and names the others again. Older states keep their
own lists and so stay readable; nothing is overwritten, and a write that fails leaves
every state as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.operators.change import Change
from reelhouse.operators.joins import in_keys
from reelhouse.sources.publish import clustered

_LIST = "files"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, bytes) of the Parquet files of a folder, from its listing alone: no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


@dataclass(frozen=True)
class Snapshot:
    """A state of a table: its folder holds the list of its files, and those written for it."""

    spark: SparkSession
    folder: str
    schema: str

    def files(self) -> DataFrame:
        """(path, name, bytes) of the files of this state, wherever they were written."""
        return self.spark.read.schema("path string, name string, bytes bigint").parquet(f"{self.folder}/{_LIST}")

    def paths(self, names: list[str] | None = None) -> list[str]:
        """Paths of all files or of some. They are as many as Spark's driver holds for any scan of the table."""
        found = self.files() if names is None else self.files().where(F.col("name").isin(names))
        return [r["path"] for r in found.select("path").collect()]

    def table(self, names: list[str] | None = None) -> DataFrame:
        """The rows of this state, or those in some of its files."""
        paths = self.paths(names)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)


def _stored(spark: SparkSession, rows: DataFrame | None, kept: DataFrame | None, schema: str, folder: str) -> Snapshot:
    """Write ``rows`` to the folder and the list of them and of the files ``kept`` beside them; the list comes last."""
    parts = [] if kept is None else [kept]
    if rows is not None:
        rows.write.mode("errorifexists").parquet(f"{folder}/data")
        parts.append(list_files(spark, f"{folder}/data"))
    files = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    files.write.mode("errorifexists").parquet(f"{folder}/{_LIST}")
    return Snapshot(spark, folder, schema)


def create_snapshot(df: DataFrame, folder: str, cluster_by: list[str] | None = None) -> Snapshot:
    """Store ``df`` as the first state of a table, in ranges of ``cluster_by`` if that is given."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return _stored(df.sparkSession, clustered(df, cluster_by) if cluster_by else df, None, schema, folder)


def _within_bounds(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` between the least and the greatest key, as constants: the reader skips files and row groups by them."""
    ordered = [c for c in on if not any(k in keys.schema[c].dataType.simpleString() for k in ("struct", "array", "map"))]
    if not ordered:
        return rows
    bounds = keys.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ordered for f in (F.min, F.max)]).first()
    for c in ordered:
        rows = rows.where(F.col(c).between(F.lit(bounds[f"min_{c}"]), F.lit(bounds[f"max_{c}"])))
    return rows


def touched_files(state: Snapshot, keys: DataFrame | None = None, on: list[str] | None = None, condition: Column | None = None) -> list[str]:
    """Names of the files with a row whose ``on`` columns are in ``keys``, or on which ``condition`` holds.

    Only these columns are read.
    """
    table = state.table()
    if not table.inputFiles():
        return []
    name = F.col("_metadata.file_name").alias("_file")
    if condition is not None:
        hit = table.where(condition).select(name)
    else:
        rows = _within_bounds(table.select(*on, name), keys, on)
        hit = in_keys(rows, keys, on)
    return [r["_file"] for r in hit.select("_file").distinct().collect()]


@dataclass(frozen=True)
class Rewrite:
    """The state after a change, the files written anew and kept, and the rows inserted, updated or deleted."""

    state: Snapshot
    rewritten: list[str]
    kept: int
    returning: DataFrame


def rewrite(
    state: Snapshot,
    folder: str,
    change: Callable[[DataFrame], Change],
    keys: DataFrame | None = None,
    on: list[str] | None = None,
    condition: Column | None = None,
) -> Rewrite:
    """The state after ``change`` of the rows that ``keys`` or ``condition`` name, in a new ``folder``.

    ``change`` gets the rows of the touched files and may alter or delete those named; it
    has to judge each row by itself and the keys, as ``update_from``, ``delete_matching``
    and ``delete_where`` do. A change that touches nothing writes a list only.
    """
    names = touched_files(state, keys, on, condition)
    done = change(state.table(names))
    kept = state.files().where(~F.col("name").isin(names)) if names else state.files()
    after = _stored(state.spark, done.state if names else None, kept, state.schema, folder)
    return Rewrite(after, names, kept.count(), done.returning)


def append(state: Snapshot, rows: DataFrame, folder: str) -> Snapshot:
    """The state with ``rows`` added: they are written, and every file there is kept."""
    return _stored(state.spark, rows, state.files(), state.schema, folder)
