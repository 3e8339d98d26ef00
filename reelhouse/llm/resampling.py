"""Importance resampling of documents towards a target: hashed n-gram gains and Gumbel keys.

Words are cut out by an untrained pre-tokenizer that gives their offsets. Windows of
successive offset pairs are the features; each is known by the bucket of its CRC-32. Every
text is tokenized once: its buckets are kept in a table beside its id, the histograms of
corpus and target are sums over such tables, and a document's weight is the sum of its
buckets' gains. The highest of weight plus noise are drawn, which is sampling without
replacement in proportion to the exponential of the weight.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.operators.numbering import number_rows

from .common import pick, written

_BLOCK = 1 << 20  # bytes of a text that are tokenized at once, more where a word is longer
# What stands between words; in ASCII-lowered text words are made of 0-9, a-z and all beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


@dataclass(frozen=True)
class Resampling:
    """``runs`` is the longest feature in words; of documents with ``least_words``, ``percent`` are drawn."""

    runs: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2") if self.buckets <= 1 << 16 else np.dtype("<u4")


def _blocks(data: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of ``data`` that do not part a word."""
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data):
            ahead = _WORD_BYTE[np.frombuffer(data[end : end + size], np.uint8)]
            if not ahead.all():
                end += int(np.argmin(ahead))
                break
            end = min(len(data), end + size)
        yield start, end
        start = end


def word_offsets(data: bytes, splitter, size: int = _BLOCK) -> np.ndarray:
    """Start and end of every word of ASCII-lowered UTF-8 ``data``, in bytes."""
    from tokenizers import PreTokenizedString

    found = []
    for start, end in _blocks(data, size):
        text = PreTokenizedString(data[start:end].decode())
        splitter.pre_tokenize(text)
        spans = [span for _, span, _ in text.get_splits("original", "byte")]
        if spans:
            found.append(np.array(spans, np.int64) + start)
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def features(data: bytes, offsets: np.ndarray, runs: int) -> Iterator[bytes]:
    """All runs of one to ``runs`` successive words, their words joined by one space."""
    words = [data[a:b] for a, b in offsets.tolist()]
    for n in range(1, runs + 1):
        yield from words if n == 1 else map(b" ".join, zip(*[words[i:] for i in range(n)]))


def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(_BETWEEN), "removed")


def bucketed(texts: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """(``id``, ``n_words``, ``n_features``, ``marks``) for the rows (id long, text) of ``texts``.

    ``marks`` holds the bucket of every feature, two bytes each (four beyond 65,536 buckets).
    """
    runs, buckets, dtype = how.runs, how.buckets, how.dtype

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = _splitter()

        def one(text: bytes | None) -> tuple[int, int, bytes]:
            data = (text or b"").lower()  # bytes: A-Z only
            offsets = word_offsets(data, splitter)
            marks = np.fromiter((zlib.crc32(f) % buckets for f in features(data, offsets, runs)), dtype)
            return len(offsets), len(marks), marks.tobytes()

        for part in parts:
            rows = pd.DataFrame([one(t) for t in part["text"]], columns=["n_words", "n_features", "marks"])
            yield rows.assign(id=part["id"].array)[["id", "n_words", "n_features", "marks"]]

    rows = texts.select("id", F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, "id long, n_words long, n_features long, marks binary")


def histogram(marked: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """(``bucket``, ``n``) over all ``marks``; each task sends at most one row a bucket."""
    buckets, dtype = how.buckets, how.dtype

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for part in parts:
            for marks in part["marks"]:
                total += np.bincount(np.frombuffer(marks, dtype), minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    return marked.select("marks").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> np.ndarray:
    """The gain of each bucket in thousandths, from two histograms of at most ``buckets`` rows each."""

    def counts(rows: DataFrame) -> list[int]:
        found = [0] * how.buckets
        for r in rows.collect():
            found[r["bucket"]] = r["n"]
        return found

    raw, wanted = counts(corpus), counts(target)
    s_all, t_all = float(sum(raw) + how.buckets), float(sum(wanted) + how.buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw, wanted)], np.int64)


def weight_of(gain: np.ndarray, dtype: np.dtype) -> Callable[[Column], Column]:
    """The sum of gains over the buckets of a column ``marks``."""

    @F.pandas_udf("long")
    def weight(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([int(gain[np.frombuffer(m, dtype)].sum()) for m in part], dtype="int64")

    return weight


def noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths out of the id's hash; a null id has the hash of its seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def resampled(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``; all long.

    ``target`` has a column ``text``. ``rank`` is null for rows that are not drawn. A null or
    empty text has no words, weight 0 and is never drawn; repeated rows count, score and
    rank each, in any order among themselves; a null id comes after others of equal score.
    Of texts of any length every word counts. With an empty target all buckets are equally
    likely in it; an empty ``docs`` gives no rows. Other columns are passed over.
    """
    of_docs = written(bucketed(pick(docs, "doc_id", "text").toDF("id", "text"), how), "buckets")
    of_target = bucketed(pick(target, "text").select(F.lit(0).cast("long").alias("id"), "text"), how)
    gain = gains(histogram(of_docs, how), histogram(of_target, how), how)
    weighed = of_docs.select(
        F.col("id").alias("doc_id"), "n_words", "n_features", weight_of(gain, how.dtype)(F.col("marks")).alias("weight")
    )
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), how.seed))
    scored = written(scored, "scores")
    drawable = scored.where(F.col("n_words") >= how.least_words)
    drawn = drawable.count() * how.percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = number_rows(drawable, order, name="place")
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")
    rest = scored.where(F.col("n_words") < how.least_words)
    return ranked.select(*columns, rank).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
