"""Column expressions and table helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.sources.session import ensure_checkpoint_dir

_shipped: set[str] = set()

SPACE = r"[ \x09-\x0D]+"


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by their exact spelling whatever other columns there are.

    A column that occurs more than once under the same name is taken where it stands first.
    """
    places = [docs.columns.index(n) for n in names]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(*[F.col(f"c{p}").alias(n) for p, n in zip(places, names)])


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all columns as the struct ``doc`` that :func:`unpacked` gives back."""
    places = [docs.columns.index(n) for n in names]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(F.struct(*plain.columns).alias("doc"), *[F.col(f"c{p}").alias(n) for p, n in zip(places, names)])


def unpacked(rows: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``docs`` out of the struct ``doc``, some of them ``replaced``."""
    columns = [F.col(f"doc.c{i}") for i in range(len(docs.columns))]
    for name, value in replaced.items():
        columns[docs.columns.index(name)] = value
    return rows.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).toDF(*docs.columns)


def with_text(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """:func:`unpacked` with another ``text``, and with its length in ``n_chars`` if ``docs`` has that column."""
    replaced = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema.fields[docs.columns.index("n_chars")].dataType
        replaced["n_chars"] = F.char_length(text).cast(kind)
    return unpacked(rows, docs, **replaced)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case, up to letters beyond ASCII.

    ``lower`` also changes letters beyond ASCII, but turns only two of them into ASCII
    letters; texts with one of these take the slower exact way.
    """
    exact = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(text.rlike("[İK]"), exact).otherwise(F.lower(text))


def indices(first: Column | int, last: Column) -> Column:
    """``first, …, last``; empty where ``last`` is smaller."""
    first = F.lit(first) if isinstance(first, int) else first
    empty = F.array().cast("array<int>")
    return F.when(last >= first, F.sequence(first, last)).otherwise(empty)


def number_array(spark: SparkSession, values: list[float]) -> Column:
    """A constant array of doubles of nine digits. Its length has to be bounded by a parameter, not by the data.

    A scalar subquery over a table of one row, as plans print every element of a literal
    array, once for each of its uses, and the driver holds these texts. Lambdas take no
    subquery: select it as a column first, apart from columns that are used several times,
    and use it once above, so that Spark puts it in place instead of copying it to each row.
    """
    row = pa.table({"values": pa.array([[float(f"{v:.9g}") for v in values]], pa.list_(pa.float64()))})
    return spark.createDataFrame(row).scalar()


def thinned(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About twice ``bound`` of ``rows``, chosen by a hash of ``key``, or all if there are fewer.

    Taken before a sample is ordered or collected, so that the sample costs its own size and
    not that times the number of tasks. Rows of one key stay or go together.
    """
    share = min(1.0, 2 * bound / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def likely_among(rows: DataFrame, ids: DataFrame, key: str, most_bits: int = 1 << 26) -> DataFrame:
    """Those of ``rows`` whose ``key`` is one of ``ids``, and about one in sixteen of the others.

    For wide rows that a join would shuffle without need; the join itself has to follow. Tasks
    look a key up in a bitmap of 16 bits for each row of ``ids``, up to ``most_bits`` (8 MB
    broadcast in all). Beyond 4 million ids more of the other rows stay, never fewer of the right ones.
    """
    bits = 1 << max(15, (16 * ids.count() - 1).bit_length())
    place = F.lit(1) + F.pmod(F.xxhash64(key), F.lit(min(bits, most_bits)))
    piece, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    pieces = ids.select(piece.alias("_piece"), at.alias("_at")).repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_there = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return rows.join(F.broadcast(pieces), (piece == F.col("_piece")) & set_there, "left_semi")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address under the folder that the cluster shares; only writers create it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder.

    For rows that are read several times or must not change when an executor is lost.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for operators with Python in their tasks."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
