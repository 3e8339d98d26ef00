"""Near-duplicates by SimHash fingerprints and a vantage-point tree.

A fingerprint is 64 majority bits over the hashes of a text's word shingles. Pairs of
fingerprints within a few differing bits are found in the metric space of the Hamming
distance: a vantage-point tree, fitted on a bounded sample, divides the space into shards.
Every fingerprint is stored in one shard, and is also sent as a query to those shards that
the triangle inequality does not rule out. Inside a shard the same pruning goes on until a
branch is small enough to compare bit by bit, so no pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.operators.joins import hot_join

from .common import packed, pick, thinned, unpacked, written

_SEED = 42
_CHUNK = 1 << 16  # hashes whose bits are unpacked at once
_CELLS = 1 << 20  # comparisons made at once


@dataclass(frozen=True)
class Search:
    """Half of ``sample`` bounds, on average, the fingerprints that reach the driver to fit the tree on.

    The tree is as deep as ``leaf`` fingerprints a shard ask for, ``depth`` at most; shards
    that are larger for it are pruned further where they are searched.
    """

    words: int = 3
    max_bits: int = 2
    leaf: int = 4096
    depth: int = 12
    sample: int = 1 << 16


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of all shingles, repeats included; a text of fewer words has one, of all its words."""
    w = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), _SEED)], np.uint64)
    shingles = map(b" ".join, zip(*[w[i:] for i in range(words)]))
    return np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), np.uint64, len(w) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of ``hashes``; zero for none."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        block = np.ascontiguousarray(hashes[i : i + _CHUNK]).astype("<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """The SimHash of a text as a long (the 64 bits as they are); zero for a null text or one without words."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            values = [majority(shingle_hashes(t or b"", words)) for t in part]
            yield pd.Series(np.array(values, np.uint64).view(np.int64))

    return of(text.cast("binary"))


def _distance(fingerprints: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(fingerprints ^ pivot).astype(np.int64)


@dataclass(frozen=True)
class Tree:
    """Nodes in heap order from 1: nearer than ``radius`` to ``pivot`` is left, the rest is right."""

    depth: int
    pivots: np.ndarray
    radii: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, depth: int, max_bits: int) -> Tree:
        """Of a few pivots, each node takes the one with the fewest sample fingerprints near its boundary."""
        pivots, radii = np.zeros(1 << depth, np.uint64), np.full(1 << depth, 32, np.int64)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            best = None
            for pivot in part[:: max(1, len(part) // 8)][:8]:
                d = _distance(part, pivot)
                radius = int(np.median(d)) + (len(d) < 2 or np.median(d) == d.min())
                cost = (np.abs(d - radius + 0.5) < max_bits + 0.5).mean() + abs((d < radius).mean() - 0.5)
                if best is None or cost < best[0]:
                    best = (cost, pivot, radius)
            if best is not None:
                pivots[node], radii[node] = best[1], best[2]
            left = _distance(part, pivots[node]) < radii[node]
            parts[2 * node], parts[2 * node + 1] = part[left], part[~left]
        return Tree(depth, pivots, radii)

    def route(self, fingerprints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, shard, home): where each is stored, and the shards before that one where it may have a neighbour.

        Of a pair in different shards, the one stored in the later shard visits the other,
        so earlier shards are enough.
        """
        index = np.arange(len(fingerprints))
        node, home = np.ones(len(index), np.int64), np.ones(len(index), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(fingerprints[index] ^ self.pivots[node]).astype(np.int64)
            inside = d < self.radii[node]
            left = d - max_bits < self.radii[node]
            right = d + max_bits >= self.radii[node]
            # A path that has left the home path to the right only leads to later shards.
            right &= ~(home & inside)
            index = np.concatenate([index[left], index[right]])
            home = np.concatenate([(home & inside)[left], (home & ~inside)[right]])
            node = np.concatenate([2 * node[left], 2 * node[right] + 1])
        return index, node - (1 << self.depth), home


def near_pairs(queries: np.ndarray, stored: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``max_bits``, in blocks: a vantage-point tree searched as it is divided."""
    todo = [(np.arange(len(queries)), np.arange(len(stored)))]
    while todo:
        q, s = todo.pop()
        if not len(q) or not len(s):
            continue
        if len(s) > 256 and len(q) > 16:
            pivot = stored[s[len(s) // 2]]
            ds = _distance(stored[s], pivot)
            radius = int(np.median(ds))
            inside = ds < radius
            if inside.any():
                dq = _distance(queries[q], pivot)
                todo += [(q[dq - max_bits < radius], s[inside]), (q[dq + max_bits >= radius], s[~inside])]
                continue
        rows = max(1, _CELLS // len(s))
        for i in range(0, len(q), rows):
            block = q[i : i + rows]
            a, b = np.nonzero(np.bitwise_count(queries[block][:, None] ^ stored[s][None, :]) <= max_bits)
            yield block[a], s[b]


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` (each points to an equal or smaller index) with the ends of the links a-b put together."""
    while len(a):
        least = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], least)
        np.minimum.at(labels, labels[b], least)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
    return labels


def _merge(labels: np.ndarray, batch: np.ndarray, stored: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.full(len(batch), -1, np.int64)
    for q, s in near_pairs(batch, stored, max_bits):
        new = first[q] < 0
        first[q[new]] = s[new]  # any one of them
        labels = _join_labels(labels, first[q], s)
    return labels, first


def shard_links(max_bits: int):
    """For ``mapInPandas`` over rows (shard, home, fp) sorted by shard, stored rows first; gives rows (u, v).

    A shard's stored fingerprints are held in memory, its queries pass by in batches.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, stored, labels = None, [], None

        def close():
            if labels is not None:
                moved = labels != np.arange(len(labels))
                if moved.any():
                    yield _edges(stored[moved], stored[labels[moved]])

        for part in parts:
            shards, fps, home = part["shard"].to_numpy(), part["fp"].to_numpy().view(np.uint64), part["home"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if shards[lo] != shard:
                    if labels is None and shard is not None:
                        stored = np.concatenate(stored) if stored else np.zeros(0, np.uint64)
                        labels, _ = _merge(np.arange(len(stored)), stored, stored, max_bits)
                    yield from close()
                    shard, stored, labels = shards[lo], [], None
                own = fps[lo:hi][home[lo:hi]]
                if len(own):
                    stored.append(own)
                queries = fps[lo:hi][~home[lo:hi]]
                if len(queries):
                    if labels is None:
                        stored = np.concatenate(stored) if stored else np.zeros(0, np.uint64)
                        labels, _ = _merge(np.arange(len(stored)), stored, stored, max_bits)
                    labels, first = _merge(labels, queries, stored, max_bits)
                    if (first >= 0).any():
                        yield _edges(queries[first >= 0], stored[first[first >= 0]])
        if labels is None and shard is not None:
            stored = np.concatenate(stored) if stored else np.zeros(0, np.uint64)
            labels, _ = _merge(np.arange(len(stored)), stored, stored, max_bits)
        yield from close()

    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"u": np.ascontiguousarray(a).view(np.int64), "v": np.ascontiguousarray(b).view(np.int64)})


def links(fingerprints: DataFrame, search: Search = Search()) -> DataFrame:
    """Links (u, v) that connect the distinct values of the column ``fp`` as all pairs within ``max_bits`` would."""
    distinct = written(fingerprints.select("fp").distinct(), "fingerprints")
    n = distinct.count()
    depth = min(search.depth, max(0, int(np.ceil(np.log2(max(1, n) / search.leaf)))))
    few = thinned(distinct, F.col("fp"), min(search.sample // 4, 16 << depth)).orderBy(F.xxhash64("fp"), "fp")
    sample = [r["fp"] for r in few.collect()] if depth else []
    tree = Tree.fit(np.array(sample, np.int64).view(np.uint64), depth, search.max_bits)
    max_bits = search.max_bits

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            fps = part["fp"].to_numpy()
            for i in range(0, len(fps), 4096):
                block = fps[i : i + 4096]
                index, shard, home = tree.route(block.view(np.uint64), max_bits)
                yield pd.DataFrame({"shard": shard.astype(np.int32), "home": home, "fp": block[index]})

    return (
        distinct.mapInPandas(route, "shard int, home boolean, fp long")
        .repartition("shard")
        .sortWithinPartitions("shard", F.col("home").desc(), "fp")
        .mapInPandas(shard_links(max_bits), "u long, v long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (u, v): the smallest node that can be reached.

    Large and small stars by turns: each round links nodes to the smallest of their
    neighbours, until no link changes. The rounds grow with the logarithm of a
    component's size. Every round is written to the shared folder.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = state(edges)
    while before[0]:
        around = both(edges)
        large = hot_join(around, least(around), ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "links")
        small = hot_join(large, least(large), ["u"])
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_groups(rows: DataFrame, search: Search = Search()) -> DataFrame:
    """(fp, root) for every distinct fingerprint in the column ``fp``: equal roots are linked, directly or over others."""
    found = components(links(rows, search))
    return (
        rows.select("fp").distinct().join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))
    )


def near_groups(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` for each row of ``docs``.

    Rows whose fingerprints differ in ``max_bits`` or fewer bits are linked;
    ``component_id`` is the smallest id that can be reached over links. Texts without a
    word, null ones included, have fingerprint zero. Repeated rows each stay. A null id is
    passed over when the smallest is taken; a group of null ids only has a null one.
    """
    marked = written(
        pick(docs, "doc_id", "text").select("doc_id", fingerprint(F.col("text"), search.words).alias("fp")), "simhash"
    )
    roots = fingerprint_groups(marked, search)
    ids = marked.groupBy("fp").agg(F.min("doc_id").alias("id")).join(roots, "fp")
    smallest = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    named = written(roots.join(smallest, "root").select("fp", "component_id"), "groups")
    return hot_join(marked, named, ["fp"], "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _content_keys() -> list[Column]:
    """128 bits that tell rows (doc_id, text) apart, nulls included."""
    none = [F.isnull("doc_id").cast("int"), F.isnull("text").cast("int")]
    return [F.xxhash64("doc_id", "text", *none).alias("k1"), F.xxhash64(*none, "text", "doc_id").alias("k2")]


def one_of_each(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """``docs`` with one row of each group of :func:`near_groups`, that of the smallest id.

    Of rows with one id, null ids last, that of the smallest text hash stays, and of rows
    with one id and one text any one. Texts without a word, null ones included, are one
    group. Texts are not copied: the fingerprint of each row is written once, and the rows
    that stay are found again by a 128-bit hash of id and text.
    """
    marked = pick(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64("text").alias("hash"), *_content_keys(), fingerprint(F.col("text"), search.words).alias("fp")
    )
    marked = written(marked, "simhash")
    texts = marked.groupBy("fp", "doc_id", "hash", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "k1", "k2", "n")
    firsts = texts.groupBy("fp").agg(F.min(order).alias("first"))
    rooted = firsts.join(fingerprint_groups(marked, search), "fp")
    kept = written(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.k1", "first.k2", "first.n"), "kept")
    rows = packed(docs, "doc_id", "text").select("doc", *_content_keys())
    once = hot_join(rows, kept.where("n = 1"), ["k1", "k2"], "left_semi")
    # Only rows that stand more than once are dealt again by their key; each task sends one of them.
    again = hot_join(rows, kept.where("n > 1"), ["k1", "k2"], "left_semi")
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))
    again = again.withColumn("place", place).where("place = 1").drop("place")
    return unpacked(once.unionByName(again), docs)
