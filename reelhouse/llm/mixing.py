"""Mixing sources to target weights in fixed-length blocks.

The words of each source form one stream, its documents in a pseudorandom order, cut into
blocks of a fixed length. Every output shard draws a multinomial count of slots for each
source. The slots of a source are numbered through and mapped to its blocks by a
pseudorandom permutation of the block numbers, a new one each time all blocks were used,
and the blocks are joined by number. All of it is built-in column functions; hashes are
taken from ``md5``, so the same draw can be made elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import indices, packed, pick, with_text, words_of, written

# Primes above any number of blocks. A prime's remainder modulo n has no
# factor in common with n, so multiplying by it permutes the numbers below n.
PRIMES = (
    1000000000000000003, 1000000000000000009, 1000000000000000031, 1000000000000000079,
    1000000000000000177, 1000000000000000183, 1000000000000000201, 1000000000000000283,
)


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources in code point order, null last, again and again.

    ``most_repeats`` bounds a source's target, and with it the use of every block.
    ``buckets`` is the number of parts in which a source's documents are put in order,
    ``bins`` that of the parts in which a draw is looked up.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    most_repeats: int = 3
    block_words: int = 32
    shard_slots: int = 65_536
    buckets: int = 65_536
    bins: int = 4_096
    seed: str = "mix"


def _hash(digits: int, *parts: Column | str) -> Column:
    """The first hexadecimal digits of the md5 of the joined parts, as a number."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source of ``sized`` (source, size): its number, size, weight and target.

    Targets share the total by weight and stop at ``most_repeats`` times a source's size;
    what is over goes to the others by weight, until none is above. In order of the level
    at which a source is full, all sources below the last level are full. The windows hold
    one row per source.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(w) for w in mix.weights])
    rows = sizes.withColumn("source_no", number - 1).withColumn("weight", F.get(weights, F.col("source_no") % len(mix.weights)))
    rows = rows.withColumn("cap", F.col("source_size") * mix.most_repeats).withColumn("level", F.col("cap") / F.col("weight"))
    order = Window.orderBy("level", "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("total", F.sum("source_size").over(everything))
    rows = rows.withColumn("rate", (F.col("total") - full) / open_weight)
    # The first source, by level, that the rate of those from it on does not fill, sets the rate for all.
    rate = F.min(F.when(F.col("rate") <= F.col("level"), F.struct("level", "source_no", "rate"))).over(everything)["rate"]
    target = F.least(F.col("cap").cast("double"), rate * F.col("weight"))
    return rows.select("source", "source_no", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _blocks(words: Column, mix: Mix) -> Column:
    return F.ceil(words / F.lit(mix.block_words)).cast("long")


def draws(sources: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The output: ``shard``, ``slot`` (numbered over all shards), ``source_no``, ``epoch``, ``block`` and ``words``.

    A source needs as many slots as blocks cover its target; the last of them takes the
    rest of the target only. Each slot draws a source with probability in proportion to
    these needs, so a shard's counts are multinomial. Where the draws of all shards give a
    source more than it needs, its last slots go to the sources that are short, in order.
    """
    needs = sources.where("source_size > 0").select(
        "source_no",
        _blocks(F.round("target"), mix).alias("need"),
        _blocks(F.col("source_size"), mix).alias("blocks"),
        F.round("target").cast("long").alias("words"),
    )
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    needs = written(needs.withColumn("first", F.coalesce(F.sum("need").over(upto), F.lit(0))), "needs")
    slots = needs.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]

    spark, per_bin = sources.sparkSession, max(1, -(-slots // mix.bins))
    bins = needs.where("need > 0").select(
        "source_no",
        "first",
        (F.col("first") + F.col("need")).alias("end"),
        F.explode(F.sequence(F.floor(F.col("first") / per_bin), F.floor((F.col("first") + F.col("need") - 1) / per_bin))).alias("bin"),
    )
    drawn = (
        spark.range(slots)
        .select(F.col("id").alias("slot"), F.floor(F.col("id") / mix.shard_slots).alias("shard"), (_hash(15, mix.seed, F.col("id")) % max(1, slots)).alias("at"))
        .withColumn("bin", F.floor(F.col("at") / per_bin))
        .join(bins, "bin")
        .where("at >= first and at < end")
        .select("shard", "slot", "source_no")
    )
    counts = written(drawn.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("n")), "counts")
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "source_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    got = needs.join(counts.groupBy("source_no").agg(F.sum("n").alias("got")), "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    got = got.withColumn("over_before", F.coalesce(F.sum(F.greatest(F.col("got") - F.col("need"), F.lit(0))).over(upto), F.lit(0)))
    got = got.withColumn("short_before", F.coalesce(F.sum(F.greatest(F.col("need") - F.col("got"), F.lit(0))).over(upto), F.lit(0)))
    got = written(got, "got")
    spare = got.where("need > got").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("need") - F.col("got") - 1)).alias("i"), "source_no", "got", "short_before"
    ).select((F.col("short_before") + F.col("i")).alias("over"), F.col("source_no").alias("to_no"), (F.col("got") + F.col("i")).alias("to_k"))

    place = F.row_number().over(Window.partitionBy("shard", "source_no").orderBy("slot")) - 1
    numbered = (
        drawn.withColumn("place", place)
        .join(starts, ["shard", "source_no"])
        .join(got.select("source_no", "need", "over_before"), "source_no")
        .withColumn("k", F.col("start") + F.col("place"))
        .withColumn("over", F.when(F.col("k") >= F.col("need"), F.col("over_before") + F.col("k") - F.col("need")))
        .join(spare, "over", "left")
        .select("shard", "slot", F.coalesce("to_no", "source_no").alias("source_no"), F.coalesce("to_k", "k").alias("k"))
    )
    permutations = needs.select("source_no", "need", "blocks", "words", F.explode(indices(0, F.lit(mix.most_repeats - 1))).alias("epoch"))
    remainders = F.sort_array(F.array(*[F.struct(F.abs(F.lit(p) % F.col("blocks") - F.floor(F.col("blocks") * 0.618)).alias("d"), (F.lit(p) % F.col("blocks")).alias("r")) for p in PRIMES]))
    permutations = permutations.withColumn("factor", F.get(remainders, F.col("epoch") % len(PRIMES))["r"]).withColumn(
        "shift", _hash(15, mix.seed, F.col("source_no"), F.col("epoch")) % F.col("blocks")
    )
    wide = "decimal(38,0)"
    return (
        numbered.join(needs.select("source_no", "blocks"), "source_no")
        .withColumn("epoch", F.floor(F.col("k") / F.col("blocks")).cast("int"))
        .drop("blocks")
        .join(permutations, ["source_no", "epoch"])
        .select(
            "shard",
            "slot",
            "source_no",
            "epoch",
            ((F.col("factor").cast("decimal(19,0)") * (F.col("k") % F.col("blocks")).cast("decimal(18,0)") + F.col("shift")).cast(wide) % F.col("blocks")).cast("long").alias("block"),
            F.when(F.col("k") == F.col("need") - 1, F.col("words") - (F.col("need") - 1) * mix.block_words).otherwise(F.lit(mix.block_words)).cast("long").alias("words"),
        )
    )


def in_streams(rows: DataFrame, sources: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``rows`` (doc_id, source, size and more) with the source's columns and ``start``, the words of its stream before them.

    A source's documents are put in order by a hash of their id, then the id, then the
    size: sums over the parts by hash, and places inside a part, so no window holds a
    whole source.
    """
    known = sources.withColumnRenamed("source", "_source")
    parted = rows.join(known, rows["source"].eqNullSafe(known["_source"])).drop("_source")
    digits = len(f"{mix.buckets - 1:x}")
    parted = parted.withColumn("_part", _hash(digits, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % mix.buckets)
    sums = parted.groupBy("source_no", "_part").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("source_no").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "_part", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source_no", "_part").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, ["source_no", "_part"])
        .withColumn("start", F.col("_before") + F.col("_inside"))
        .drop("_part", "_before", "_inside")
    )


def pieces(placed: DataFrame, slots: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The words taken of each document in each epoch: ``source_no``, ``start`` (the document), ``epoch``, ``first``, ``end``.

    ``first`` and ``end`` count words of the document. Documents without words have none.
    """
    b = mix.block_words
    parts = placed.where("size > 0").select(
        "source_no",
        "start",
        "size",
        F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block"),
    )
    at = F.col("block") * b
    # Spark estimates the exploded rows by the table before it, and would broadcast them.
    return (
        parts.hint("merge").join(slots.select("source_no", "block", "epoch", "words"), ["source_no", "block"])
        .select(
            "source_no",
            "start",
            "size",
            "epoch",
            (F.greatest(at, F.col("start")) - F.col("start")).alias("first"),
            (F.least(at + F.col("words"), F.col("start") + F.col("size")) - F.col("start")).alias("end"),
        )
        .where("end > first")
    )


def _sized(rows: DataFrame) -> DataFrame:
    return rows.withColumn("size", F.size(words_of(F.col("text"))).cast("long"))


def words_taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` for each row of ``docs``.

    A null text has no words, and a row without words is never taken. Null sources are one
    source. Repeated rows are taken each by itself.
    """
    rows = written(_sized(pick(docs, "doc_id", "source", "text")).drop("text"), "sizes")
    sources = written(source_targets(rows, mix), "sources")
    placed = written(in_streams(rows, sources, mix), "placed")
    taken = pieces(placed, draws(sources, mix), mix).groupBy("source_no", "start").agg(F.sum(F.col("end") - F.col("first")).alias("taken"))
    filled = placed.where("size > 0").join(taken, ["source_no", "start"], "left")
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return filled.select(*columns).unionByName(empty.select(*columns))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one for each document and each epoch it is taken in.

    A document that is taken whole keeps its text as it is; of one that is taken in part
    the taken words remain, in order and with single spaces. ``n_chars``, where there is one, is counted anew.
    """
    rows = _sized(packed(docs, "doc_id", "source", "text")).drop("text")
    sources = written(source_targets(_sized(pick(docs, "source", "text")).drop("text"), mix), "sources")
    placed = written(in_streams(rows, sources, mix).where("size > 0"), "placed")
    taken = (
        pieces(placed.drop("doc"), draws(sources, mix), mix)
        .groupBy("source_no", "start", "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("runs"), F.sum(F.col("end") - F.col("first")).alias("n"))
    )
    text = F.col(f"doc.c{docs.columns.index('text')}")
    words = words_of(text)
    runs = F.transform("runs", lambda r: F.array_join(F.slice(F.col("words"), (r["first"] + 1).cast("int"), (r["end"] - r["first"]).cast("int")), " "))
    part = F.array_join(runs, " ")
    rows = placed.join(taken, ["source_no", "start"])
    rows = rows.withColumn("words", F.when(F.col("n") < F.col("size"), words))
    rows = rows.withColumn("new", F.when(F.col("n") < F.col("size"), part).otherwise(text))
    return with_text(rows, docs, F.col("new"))
