"""Session set-up."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", app: str = "reelhouse", memory: str = "8g", warehouse: str | None = None
) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    A cluster brings its own session; nothing in the operators depends on this one.
    """
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The folder the session names in ``spark.checkpoint.dir`` is used. Only a local
    master may fall back to a temporary folder: on a cluster that folder would be
    private to one machine and be lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="reelhouse-checkpoint-")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder.

    For a batch that one change reads several times: it is not computed again each
    time, and every reader sees the same rows even after executors were lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address beside the checkpoints, which all executors share; only writers create it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as Parquet files beside the checkpoints.

    For loops that join their own outcome again and again: a checkpoint keeps the size that
    was estimated for the plan behind it, and a join's estimate is the product of its
    sides', so that it grows beyond all bounds; files have the size they have.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "stored")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
