"""Document fingerprints by Order MinHash.

A text is seen as the sequence of its word k-mers, each numbered by how often it occurred
before. For every sketch a hash function gives all numbered k-mers an order; the least of
each of two strata of that hash are selected, put back into text order, and hashed as a
pair. Two texts agree in a sketch only if they share both k-mers and have them in the same
order, so the share of equal sketches falls with the edit distance, not only with the set
of k-mers. All of it is built-in column functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import indices, let, pick, thinned, words_of

_PLACE_BITS = 31  # the low bits of a selected value are its k-mer's place, the others its hash


@dataclass(frozen=True)
class Sketching:
    """``kmer`` words make a k-mer; ``sketches`` pairs make a fingerprint.

    About ``sample`` ids for each part, chosen by hash, are brought to the driver to divide
    the id range into even parts.
    """

    kmer: int = 3
    sketches: int = 32
    sample: int = 20


def numbered_kmers(text: Column, k: int) -> Column:
    """The hashes of a text's k-mers in text order, the second and later occurrences hashed with their number.

    A text of fewer than ``k`` words has one k-mer, of all its words; one without words has none.
    """

    def number(hashes: Column) -> Column:
        tagged = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def renumber(s: Column) -> Column:
            firsts = F.filter(indices(0, F.size(s) - 1), lambda j: (j == 0) | (F.get(s, j)["h"] != F.get(s, j - 1)["h"]))

            def runs(f: Column) -> Column:
                def run(first: Column, r: Column) -> Column:
                    end = F.coalesce(F.get(f, r + 1), F.size(s)) - 1

                    def one(j: Column) -> Column:
                        h = F.get(s, j)["h"]
                        return F.struct(
                            F.get(s, j)["i"].alias("i"), F.when(j == first, h).otherwise(F.xxhash64(h, j - first)).alias("h")
                        )

                    return F.transform(F.sequence(first, end), one)

                return F.transform(F.sort_array(F.flatten(F.transform(f, run))), lambda x: x["h"])

            return let(firsts, runs)

        repeats = let(F.sort_array(tagged), renumber)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(repeats)

    def hashes(w: Column) -> Column:
        kmers = F.transform(indices(0, F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        whole = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when((F.size(w) > 0) & (F.size(w) < k), whole).otherwise(kmers)

    return let(words_of(text), lambda w: let(hashes(w), number))


def sketched(rows: DataFrame, keys: list[str], text: str, sketching: Sketching = Sketching()) -> DataFrame:
    """The ``keys`` of each row, which have to be unique, and ``sketches``: an array of 32-bit numbers, all zero without words.

    The k-mers of a text are rows only up to an aggregation by key in the same task, where
    ``rows`` are partitioned by one of the keys already.
    """
    kmers = rows.select(*keys, F.posexplode_outer(numbered_kmers(F.col(text), sketching.kmer)).alias("_place", "_kmer"))
    low = F.lit((1 << _PLACE_BITS) - 1)
    hashes = [F.xxhash64("_kmer", F.lit(i)).alias(f"_x{i}") for i in range(sketching.sketches)]
    kmers = kmers.select(*keys, "_place", "_kmer", *hashes)

    def least(i: int, stratum: int) -> Column:
        x = F.col(f"_x{i}")
        mine = F.col("_kmer").isNotNull() & (x.bitwiseAND(F.lit(1)) == stratum)
        return F.min(F.when(mine, x.bitwiseAND(F.lit(~((1 << _PLACE_BITS) - 1))).bitwiseOR(F.col("_place").cast("long"))))

    selected = kmers.groupBy(*keys).agg(*[least(i, s).alias(f"_m{i}_{s}") for i in range(sketching.sketches) for s in (0, 1)])

    def pair(i: int) -> Column:
        a, b = F.col(f"_m{i}_0"), F.col(f"_m{i}_1")
        hash_of = lambda v: F.shiftright(v, _PLACE_BITS)
        in_order = F.coalesce(a.bitwiseAND(low) < b.bitwiseAND(low), a.isNotNull())
        both = F.when(in_order, F.xxhash64(hash_of(a), hash_of(b))).otherwise(F.xxhash64(hash_of(b), hash_of(a)))
        short = both.bitwiseAND(F.lit((1 << 32) - 1))
        return F.when(a.isNull() & b.isNull(), F.lit(0).cast("long")).otherwise(short)

    return selected.select(*keys, F.array(*[pair(i) for i in range(sketching.sketches)]).alias("sketches"))


def likeness(a: Column, b: Column) -> Column:
    """The share of sketches in which two fingerprints agree."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(equal) / F.size(a)


def as_text(sketches: Column) -> Column:
    """Eight hexadecimal digits for each sketch."""
    return F.array_join(F.transform(sketches, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprints(docs: DataFrame, sketching: Sketching = Sketching()) -> DataFrame:
    """``doc_id`` and ``fingerprint`` for each row of ``docs``; null texts count as empty, repeated rows each stay."""
    rows = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return sketched(rows, ["row", "doc_id"], "text", sketching).select("doc_id", as_text(F.col("sketches")).alias("fingerprint"))


def _chunked(docs: DataFrame, sketching: Sketching) -> DataFrame:
    """``doc_id``, ``text`` (null: empty), ``hash``, ``chunk`` and ``extra``.

    A chunk is a range of ids, with the first row of the next chunk once more as its
    ``extra`` last row; the last chunk has the very first row there. Chunk bounds are ids
    of a bounded sample: they make the chunks even and have no part in the result.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.where(F.col("doc_id").isNotNull()).select("doc_id")
    sample = sorted(r[0] for r in thinned(ids, F.col("doc_id"), parts * sketching.sample // 2).distinct().collect())
    bounds = [F.lit(sample[i]) for i in range(sketching.sample, len(sample), sketching.sample)]
    chunk = F.size(F.filter(F.array(*bounds), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    rows = rows.withColumn("chunk", chunk)

    first_id = rows.groupBy("chunk").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("has_null"))
    first_id = first_id.select("chunk", F.when(~F.col("has_null"), F.col("id")).alias("first_id"))  # one row for each chunk
    order = Window.orderBy("chunk")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = F.coalesce(F.lag("chunk").over(order), F.last("chunk").over(whole))
    first_id = first_id.withColumn("to", to)
    firsts = (
        rows.join(F.broadcast(first_id), "chunk")
        .where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("chunk", "to")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "doc_id", "text")).alias("row"))
        .select("row.doc_id", "row.text", "row.hash", F.col("to").alias("chunk"), F.lit(1).alias("extra"))
    )
    return rows.select("doc_id", "text", F.xxhash64("text").alias("hash"), "chunk", F.lit(0).alias("extra")).unionByName(firsts)


def edited_likeness(docs: DataFrame, sketching: Sketching = Sketching()) -> DataFrame:
    """Each text's fingerprint against those of an edited form and of the next document.

    The edited text has its last half replaced by as many first characters of the next
    document by ascending id, or all of them; the last document is followed by the first,
    and null ids come first. Rows of one id are in order of their text's hash. Gives
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``.
    """
    inside = Window.partitionBy("chunk").orderBy("extra", F.col("doc_id").asc_nulls_first(), "hash")
    rows = _chunked(docs, sketching).select(
        "chunk", "doc_id", "extra", "text", F.row_number().over(inside).alias("place"), F.lead("text").over(inside).alias("next")
    )
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half)))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    both = F.when(F.col("extra") == 0, F.array("text", "edited")).otherwise(F.array("text"))
    keys = ["chunk", "place", "version", "extra", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.select("chunk", "place", "extra", "doc_id", "n_chars", "edited_sha256", F.posexplode(both).alias("version", "body"))
    sketches = sketched(rows, keys, "body", sketching)
    after = Window.partitionBy("chunk").orderBy("place", "version")
    sketches = sketches.withColumn("edited", F.lead("sketches", 1).over(after)).withColumn("next", F.lead("sketches", 2).over(after))
    return sketches.where("extra = 0 and version = 0").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketches")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("sketches"), F.col("edited")).alias("near_edited"),
        likeness(F.col("sketches"), F.col("next")).alias("near_next"),
    )
