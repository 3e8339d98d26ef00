"""Language identification by nearest centroids.

A text is a normalised TF-IDF vector over hashed character n-grams. Each language has
several centroids, from a spherical k-means over a bounded sample of its texts; a text gets
the language of the nearest centroid by cosine, and is marked as rejected when it is farther
from it than that centroid's own texts are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, ship, written

UNKNOWN = "und"
_BLOCK = 256  # texts whose vectors are held at once
_SPACE = 32

_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the texts of a language that its centroids are fitted on, those whose ids have the least hashes.

    Document frequencies are counted over all labelled texts. ``slack`` is how much farther
    than the farthest of its sample a text may be from a centroid and still be accepted.
    """

    buckets: int = 4096
    grams: tuple[int, ...] = (1, 2, 3)
    sample: int = 400
    centroids: int = 4
    rounds: int = 12
    broadcast_languages: int = 10_000
    slack: float = 1.1


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _letters[0]


def counts_of(text: str | None, training: Training) -> np.ndarray | None:
    """Hashed counts of the n-grams of letters, other characters standing as one space; None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    after_letter = np.concatenate([[False], letter[:-1]])
    codes = np.concatenate([[_SPACE], np.where(letter, codes, _SPACE)[letter | after_letter], [_SPACE]]).astype(np.uint64)
    total = np.zeros(training.buckets, np.int64)
    with np.errstate(over="ignore"):
        for n in training.grams:
            if len(codes) < n:
                continue
            h = np.full(len(codes) - n + 1, np.uint64(n))
            for i in range(n):
                h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            total += np.bincount((h % np.uint64(training.buckets)).astype(np.int64), minlength=training.buckets)
    return total


def vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(np.array(counts, np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def inverse_frequencies(texts: DataFrame, training: Training = Training()) -> np.ndarray:
    """Smoothed inverse document frequencies of the buckets, over all rows of ``texts`` (text)."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(training.buckets, np.int64), 0
        for part in parts:
            for text in part["text"]:
                own = counts_of(text, training)
                if own is not None:
                    seen += own > 0
                    n += 1
        bucket = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(bucket, -1), "n": np.append(seen[bucket], n)})

    summed = texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = {r["bucket"]: r["n"] for r in summed.collect()}  # at most one row per bucket, and the number of texts
    n = rows.pop(-1, 0)
    frequencies = np.zeros(training.buckets)
    for bucket, seen in rows.items():
        frequencies[bucket] = seen
    return (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)


def _cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means that starts from the rows farthest from those chosen before."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(k, len(x)):
        nearest = (x @ x[chosen].T).max(1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(np.argmin(nearest)))
    centres = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        moved = np.array([x[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres.astype(np.float32)


@dataclass(frozen=True)
class Model:
    training: Training
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    reach: np.ndarray  # the largest distance that is accepted


def _sampled(labelled: DataFrame, training: Training) -> DataFrame:
    """At most ``sample`` rows of each language, thinned by hash before they are ordered."""
    sizes = written(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    # So that texts are thinned where they are read; with more languages they meet their size in a shuffle.
    if sizes.count() <= training.broadcast_languages:
        sizes = F.broadcast(sizes)
    place = F.xxhash64("doc_id", "text")
    share = F.lit(float(2 * training.sample << 20)) / F.col("n")
    thin = labelled.withColumn("hash", place).join(sizes, "lang").where(F.pmod(F.col("hash"), F.lit(1 << 20)) < share)
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    return thin.withColumn("place", F.row_number().over(order)).where(F.col("place") <= training.sample).select("lang", "text")


def fit(labelled: DataFrame, training: Training = Training()) -> Model:
    """A model from rows (doc_id, text, lang); rows without a language or a letter teach nothing.

    The centroids of each language are fitted in a task of its own. What reaches the driver
    is a vector for each centroid.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = inverse_frequencies(labelled, training)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        counts = [c for c in (counts_of(t, training) for t in rows["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "vector": [], "reach": []})
        x = vectors(counts, idf)
        centres = _cluster(x, training.centroids, training.rounds)
        near = x @ centres.T
        own = np.argmax(near, axis=1)
        reach = [float(1 - near[own == c, c].min()) * training.slack if (own == c).any() else 0.0 for c in range(len(centres))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "vector": list(centres), "reach": reach})

    fitted = _sampled(labelled, training).groupBy("lang").applyInPandas(one, "lang string, vector array<float>, reach double")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], r["vector"]))
    centroids = np.array([r["vector"] for r in rows], np.float32).reshape(len(rows), training.buckets)
    return Model(training, idf, [r["lang"] for r in rows], centroids, np.array([r["reach"] for r in rows]))


def _predicted(texts: Iterable[str | None], model: Model) -> pd.DataFrame:
    langs, scores, rejected = [], [], []
    block: list[np.ndarray] = []
    places: list[int] = []

    def close() -> None:
        if not block:
            return
        near = vectors(block, model.idf) @ model.centroids.T
        best = np.argmax(near, axis=1)
        for place, c, score in zip(places, best, near[np.arange(len(best)), best]):
            langs[place], scores[place] = model.languages[c], float(min(1.0, max(0.0, score)))
            rejected[place] = bool(1 - score > model.reach[c])
        block.clear()
        places.clear()

    for place, text in enumerate(texts):
        counts = counts_of(text, model.training) if model.languages else None
        langs.append(UNKNOWN)
        scores.append(0.0)
        rejected.append(True)
        if counts is not None:
            block.append(counts)
            places.append(place)
            if len(block) == _BLOCK:
                close()
    close()
    return pd.DataFrame({"lang": langs, "score": scores, "rejected": rejected})


def language(text: Column, model: Model) -> Column:
    """A struct of ``lang``, ``score`` (cosine, 0 to 1) and ``rejected``.

    A null text or one without a letter is ``und`` with score 0, and so is every text if
    nothing was learned. Between equally near centroids the first language in order is taken.
    """

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield _predicted(part, model)

    return predict(text)


def held_out(doc_id: Column) -> Column:
    """Whether the id's check sum leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected`` for each row of ``docs``.

    The model learns from the rows that are not held out. One row per row, repeated rows
    and null ids included.
    """
    ship(docs.sparkSession)
    rows = pick(docs, "doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(rows.where(~F.col("held_out")), training)
    found = rows.select("doc_id", "held_out", language(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")
