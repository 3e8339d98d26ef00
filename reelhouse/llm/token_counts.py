"""Token counts of texts of any length, huge ones in overlapping chunks.

Short texts are counted as they come. A huge text is cut into chunks that overlap and are
dealt over the cluster. Every chunk is encoded with offsets, and two neighbours are spliced
where both have a boundary between pre-tokens in their overlap. Such a boundary is proven:
the tokenizer matches pre-tokens from left to right and looks ahead only, so from a common
boundary on both go the same way, and a pre-token that ends a margin before a chunk's end
is not changed by what follows. Where an overlap has no common boundary it is widened to
the whole of both chunks, until every text is spliced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.operators.joins import hot_join

from .common import pick, written

_TEXT_AT_ONCE = 1 << 20  # characters whose parts are looked up together
_CACHED = 250_000  # parts in each of two generations of the cache
_LONGEST_CACHED = 64  # characters of a part that is kept
# White space, and format characters that some tables count as such, in front of a space.
_NO_CUT = re.compile(r"[\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff] ")

_counters: dict[str, "Counter"] = {}


@dataclass(frozen=True)
class Counting:
    """Texts of over ``chunk`` characters are cut; neighbours share ``overlap`` characters, less than half a chunk."""

    chunk: int = 1 << 15
    overlap: int = 512
    limit: int = 512

    def __post_init__(self) -> None:
        if not 0 < 2 * self.overlap < self.chunk:
            raise ValueError("the overlap must be less than half a chunk")


class Counter:
    """A tokenizer that counts, and marks where its pre-tokens end.

    ``margin`` is None for tokenizers whose pre-tokens are not known to be matched from left
    to right with a bounded look ahead: byte-level ones without a normalizer are. Their
    margin is the longest string they treat as special, or a contraction's three characters.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        self.margin = None
        special = spec["added_tokens"]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]) for t in special)
        if spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and plain:
            if not before.get("add_prefix_space"):
                self.margin = 1 + max([3, *(len(t["content"]) for t in special)])
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    @staticmethod
    def of(path: str) -> "Counter":
        if path not in _counters:
            _counters[path] = Counter(path)
        return _counters[path]

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts_counted(self, texts: list[list[str]]) -> list[int]:
        """Tokens of texts given as their parts between spaces, of which all but the first follow a space."""
        unknown = []
        for part in set().union(*(parts[1:] for parts in texts)):
            if part not in self.new:
                if part in self.old:
                    self.new[part] = self.old[part]
                else:
                    unknown.append(part)
        self.new.update(zip(unknown, self.whole([" " + p for p in unknown])))
        known = self.new
        counts = [n + sum(map(known.__getitem__, parts[1:])) for n, parts in zip(self.whole([p[0] for p in texts]), texts)]
        if len(known) > _CACHED:
            self.old, self.new = {p: n for p, n in known.items() if len(p) <= _LONGEST_CACHED}, {}
        return counts

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text.

        A space behind a character that is not white space always begins a pre-token, so
        texts without other spaces are counted part by part, parts met before from a cache.
        """
        if self.margin is None:
            return self.whole(texts)
        out, batch, size = np.zeros(len(texts), np.int64), [], 0
        for i, text in enumerate(texts):
            if text[:1] == " " or _NO_CUT.search(text):
                out[i] = self.whole([text])[0]
                continue
            batch.append((i, text.split(" ")))
            size += len(text)
            if size >= _TEXT_AT_ONCE:
                out[[j for j, _ in batch]] = self._parts_counted([p for _, p in batch])
                batch, size = [], 0
        if batch:
            out[[j for j, _ in batch]] = self._parts_counted([p for _, p in batch])
        return out.tolist()

    def boundaries(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; where pre-tokens begin, in characters; and the tokens before each of these."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        words = np.array(found.word_ids, np.int64)
        first = np.flatnonzero(np.diff(words, prepend=-1) != 0)
        starts = np.array([a for a, _ in found.offsets], np.int64)
        return len(words), starts[first], first


def _slices(text: str, how: Counting) -> Iterator[tuple[int, str]]:
    for start in range(0, len(text) - how.overlap, how.chunk - how.overlap):
        yield start, text[start : start + how.chunk]


def counted_or_cut(docs: DataFrame, tokenizer: str, how: Counting) -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens, start, slice): the count of a text, or its slices with no count yet."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter.of(tokenizer)
        longest = how.chunk if counter.margin is not None and counter.margin < how.overlap else 1 << 31
        for part in parts:
            texts = ["" if t is None else t for t in part["text"]]
            short = [len(t) <= longest for t in texts]
            counts = iter(counter.counts([t for t, s in zip(texts, short) if s]))
            rows, ids, sizes = part["row"].tolist(), part["doc_id"].array, [len(t.encode()) for t in texts]
            places, out = [], []
            for i, text in enumerate(texts):
                for start, piece in [(0, None)] if short[i] else _slices(text, how):
                    places.append(i)
                    out.append((rows[i], sizes[i], next(counts) if short[i] else None, start, piece))
            frame = pd.DataFrame(out, columns=["row", "n_bytes", "n_tokens", "start", "slice"])
            frame["n_tokens"] = frame["n_tokens"].astype("Int64")
            yield frame.assign(doc_id=ids.take(places))[["row", "doc_id", "n_bytes", "n_tokens", "start", "slice"]]

    rows = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"row long, doc_id {kind}, n_bytes long, n_tokens long, start long, slice string")


_MARKED = "row long, start long, n long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"


def marked(slices: DataFrame, tokenizer: str, how: Counting) -> DataFrame:
    """Tokens of each (row, start, slice), and the pre-token boundaries near its two ends with the tokens before them.

    Boundaries at the end keep the margin, so that they are those of the whole text.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter.of(tokenizer)
        for part in parts:
            out = []
            for row, start, text in part.itertuples(index=False):
                n, at, before = counter.boundaries(text)
                head = at <= how.overlap
                tail = (at >= len(text) - how.overlap) & (at <= len(text) - counter.margin)
                out.append((row, start, n, *(list(x) for x in (at[head] + start, before[head], at[tail] + start, before[tail]))))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _MARKED.split(", ")])

    # Slices of one text are dealt over tasks, so that one huge text does not stay in one.
    dealt = slices.select("row", "start", "slice").repartition("row", "start")
    return dealt.mapInPandas(run, _MARKED)


def _at(counts: str, places: str, place: Column) -> Column:
    return F.element_at(counts, F.array_position(places, place).cast("int"))


def spliced(ends: DataFrame) -> DataFrame:
    """``ends`` (see :func:`marked`) with ``last``, and ``used``: its tokens between the splices at its two ends, null where one fails."""
    order = Window.partitionBy("row").orderBy("start")
    nexts = ends.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("start", "head_at", "head_n")})
    common = F.array_max(F.array_intersect("tail_at", "next_head_at"))
    nexts = nexts.withColumn("last", F.isnull("next_start")).withColumn("splice", common)
    upto = F.when(F.col("last"), F.col("n")).otherwise(_at("tail_n", "tail_at", F.col("splice")))
    skipped = F.when(F.col("last"), F.lit(0)).otherwise(_at("next_head_n", "next_head_at", F.col("splice")))
    return nexts.withColumn("used", upto - skipped).drop("next_head_at", "next_head_n", "next_start")


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """One slice out of some that follow each other with overlaps."""
    rows = rows.sort_values("start")
    parts, end = [], int(rows["start"].iloc[0])
    for start, text in zip(rows["start"], rows["slice"]):
        parts.append(text[end - start :])
        end = start + len(text)
    return pd.DataFrame({"row": rows["row"].iloc[:1], "start": rows["start"].iloc[:1], "slice": ["".join(parts)]})


def counted_in_chunks(slices: DataFrame, tokenizer: str, how: Counting) -> DataFrame:
    """(row, n_tokens) of texts given as slices that overlap.

    Neighbours without a common boundary become one slice and are encoded again. At most
    the slices of one text come together so, where no pre-token ends in any overlap.
    """
    ends = written(marked(slices, tokenizer, how), "chunk-ends")
    while True:
        state = written(spliced(ends), "splices")
        if state.where("used is null").isEmpty():
            return state.groupBy("row").agg(F.sum("used").alias("n_tokens"))
        order = Window.partitionBy("row").orderBy("start")
        before = F.lag(F.isnull("used"), 1, False).over(order)
        runs = state.withColumn("begins", (~before).cast("long"))
        runs = runs.withColumn("run", F.sum("begins").over(order))
        runs = runs.withColumn("open", F.isnull("used") | (F.col("begins") == 0))
        runs = written(runs.select("row", "start", "run", "open"), "runs")
        again = slices.join(runs.where("open").select("row", "start", "run"), ["row", "start"])
        wider = written(again.groupBy("row", "run").applyInPandas(_joined, "row long, start long, slice string"), "wider")
        kept = runs.where("not open").select("row", "start")
        whole = written(slices.select("row", "start", "slice").join(kept, ["row", "start"], "left_semi").unionByName(wider), "slices")
        same = ends.join(kept, ["row", "start"], "left_semi")
        ends = written(same.unionByName(marked(wider, tokenizer, how)), "chunk-ends")
        slices = whole


def token_counts(docs: DataFrame, tokenizer: str, how: Counting = Counting()) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    Counts are the tokenizer's for the whole text, without added special tokens; its special
    strings within a text are handled as it does by default. A null text is empty and has
    none. Repeated rows and null ids each stay; other columns are passed over; no rows give
    no rows. Texts of any length are counted whole. Tokenizers for which no splice is proven
    (see :class:`Counter`) encode every text in one piece.
    """
    table = written(counted_or_cut(docs, tokenizer, how), "token-counts")
    slices = table.where("slice is not null")
    columns = ["doc_id", "n_bytes", "n_tokens"]
    counts = table.where("slice is null").select(*columns)
    if not slices.isEmpty():
        huge = counted_in_chunks(slices, tokenizer, how)
        named = hot_join(slices.where("start = 0").select("row", "doc_id", "n_bytes"), huge, ["row"])
        counts = counts.unionByName(named.select(*columns))
    return counts.withColumn("over_limit", F.col("n_tokens") > how.limit)
