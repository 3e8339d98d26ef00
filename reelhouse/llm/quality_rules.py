"""Quality rules: repetition rules and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to a fixed number of buckets. Two multinomials over the
buckets are counted, one over trusted documents and one over the whole corpus. A
document's score is the mean, over its words and pairs, of the logarithm of the two
bucket probabilities' ratio. The threshold follows from the trusted documents themselves:
each is scored by the counts of the half that it is not in, and a document is kept when its
score reaches a low quantile of these. All of it is built-in column functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import let, likely_among, number_array, packed, pick, unpacked, words_of, written


@dataclass(frozen=True)
class Rules:
    """``buckets`` also bounds what reaches the driver: one weight per bucket.

    ``trusted`` bounded the trusted documents once and has no effect any more: all of them
    are counted. ``prior`` is the number of n-grams in a bucket that are taken to follow the
    corpus before any is counted. ``rejected`` is the share of trusted documents, scored by
    others, that the threshold would reject.
    """

    buckets: int = 1 << 16
    trusted: int = 20_000
    prior: float = 1.0
    rejected: float = 0.002
    least_words: int = 50
    most_repeated_percent: int = 50


def repeated_words(words: Column) -> Column:
    """The number of words that lie in a three-word window found twice or more in ``words``.

    Windows are compared by 64-bit hash. Only texts with a repeated window are sorted; the
    places of repeated windows, in order, cover three words each less what overlaps.
    """

    def covered(hashes: Column) -> Column:
        tagged = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def places(s: Column) -> Column:
            def again(x: Column, j: Column) -> Column:
                before, after = F.get(s, j - 1)["h"], F.get(s, j + 1)["h"]
                return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"]))

        def width(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda n, g: n + g)

        repeats = let(F.sort_array(tagged), lambda s: let(places(s), width))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), repeats).otherwise(F.lit(0))

    def hashes(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))
        return F.zip_with(pairs, F.slice(w, 3, n), lambda h, c: F.xxhash64(h, c))

    return let(words, lambda w: let(hashes(w), covered)).cast("long")


def repeated_lines(text: Column) -> Column:
    """The number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_measures(text: Column, words: Column, rules: Rules) -> dict[str, Column]:
    """The measures of the plain rules; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": repeated_lines(text),
        "n_repeat_words": repeated_words(words),
    }


def _neighbours(values: Column) -> tuple[Column, Column]:
    """All values but the last, and all but the first."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.slice(values, 1, n), F.slice(values, 2, n)


def _bucket(rules: Rules, *words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(rules.buckets)).cast("int")


def features(words: Column, rules: Rules) -> Column:
    """The buckets of all words, then of all pairs of neighbours."""

    def both(w: Column) -> Column:
        pairs = F.zip_with(*_neighbours(w), lambda a, b: _bucket(rules, a, b))
        return F.concat(F.transform(w, lambda x: _bucket(rules, x)), pairs)

    return let(words, both)


@dataclass(frozen=True)
class Fit:
    """``weights`` of all buckets, and the smallest score of a kept document: none where nothing can be said."""

    weights: list[float]
    threshold: float | None


def _failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated_percent * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> Fit:
    """The log-ratio of every bucket, from all n-grams of ``docs``, and the threshold.

    Trusted are all documents with quality 1 and no toxic mark, in two halves by a hash of
    the id. Both sides of the join with their ids are shuffled, of the documents those that
    :func:`likely_among` leaves; only n-grams and judgements of the trusted ones are kept for
    the two counts and the scores. Null ids are never
    trusted. Without trusted n-grams all ratios are zero; without some in each half, or none
    that pass the plain rules, there is no threshold.
    """
    trusted = (
        pick(labels, "doc_id", "quality", "toxic")
        .where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("string").alias("id"))
    )
    rows = pick(docs, "doc_id", "text").withColumn("id", F.col("doc_id").cast("string"))
    raw = _counts(rows.select(F.lit(0).alias("part"), F.explode(features(words_of(F.col("text")), rules)).alias("bucket")), 1, rules)[0]

    own = likely_among(rows, trusted, "id").join(trusted.distinct().hint("merge"), "id").withColumn("words", words_of(F.col("text")))
    measures = base_measures(F.col("text"), F.col("words"), rules)
    own = own.select("id", features(F.col("words"), rules).alias("grams"), *[measures[m].alias(m) for m in ("n_words", "n_repeat_words")])
    half = F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half")
    own = written(own.select(half, "grams", (~_failed(rules)).alias("passed")), "trusted")
    halves = _counts(own.select(F.col("half").alias("part"), F.explode("grams").alias("bucket")), 2, rules)

    def weights(good: list[int]) -> list[float]:
        n_raw, n_good = sum(raw), sum(good)
        if n_good == 0:
            return [0.0] * rules.buckets
        return [math.log((g + rules.prior) / (r * n_good / n_raw + rules.prior)) for g, r in zip(good, raw)]

    of_all = weights([a + b for a, b in zip(*halves)])
    if not all(map(sum, halves)):
        return Fit(of_all, None)
    of_others = [number_array(docs.sparkSession, weights(halves[1 - h])).alias(f"weights{h}") for h in (0, 1)]
    first, second = (_mean_weight(F.col("grams"), F.col(f"weights{h}")) for h in (0, 1))
    scores = own.where("passed").select("half", "grams", *of_others).select(F.when(F.col("half") == 0, first).otherwise(second).alias("score"))
    return Fit(of_all, _quantile(written(scores, "held-out"), rules.rejected))


def _counts(rows: DataFrame, parts: int, rules: Rules) -> list[list[int]]:
    """The number of ``rows`` (part, bucket) of each part in each bucket, gathered as two columns, not as rows."""
    found = rows.groupBy("part", "bucket").count().toArrow()
    counts = np.zeros((parts, rules.buckets), np.int64)
    counts[found["part"].to_numpy(), found["bucket"].to_numpy()] = found["count"].to_numpy()
    return counts.tolist()


_DIGITS = 6  # of a score
_COARSE = 1 << 10  # scores in a step of the first count


def _quantile(scores: DataFrame, share: float) -> float | None:
    """The exact quantile of ``score``, between two ranks in proportion as in ``percentile``; none without rows.

    Scores have six digits. They are counted in steps of 1,024 of these, and those of the
    steps with the two ranks one by one, so what is gathered is bounded by the range of scores.
    """
    fine = F.round(F.col("score") * 10**_DIGITS).cast("long")
    steps = scores.groupBy(F.floor(fine / _COARSE).alias("step")).count().orderBy("step").collect()
    place = (sum(r["count"] for r in steps) - 1) * share
    ranks, before, wanted = (math.floor(place), math.ceil(place)), 0, {}
    if place < 0 or not steps:
        return None
    for step in steps:
        if any(before <= r < before + step["count"] for r in ranks):
            wanted[step["step"]] = before
        before += step["count"]
    found = scores.where(F.floor(fine / _COARSE).isin(*wanted)).groupBy("score").count().orderBy("score").collect()
    at, values = min(wanted.values()), {}
    for row in found:
        values.update({r: row["score"] for r in ranks if at <= r < at + row["count"]})
        at += row["count"]
    low, high = (values[r] for r in ranks)
    return low if low == high else (ranks[1] - place) * low + (place - ranks[0]) * high


def _mean_weight(buckets: Column, weights: Column) -> Column:
    total = F.aggregate(buckets, F.lit(0.0), lambda s, b: s + F.get(weights, b)) / F.greatest(F.size(buckets), F.lit(1))
    return F.round(total, _DIGITS)


def mean_ratio(words: Column, weights: Column, rules: Rules) -> Column:
    """The mean log-ratio of a text's n-grams; zero without words. ``weights`` is the array of all buckets' log-ratios."""
    return let(features(words, rules), lambda f: _mean_weight(f, weights))


def judged(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc`` (all columns of a row), ``doc_id`` and ``text`` with the measures, ``score``, ``base_failed`` and ``kept``.

    One row per row of ``docs``, repeated rows and null ids included. A null or empty text
    has no words and so fails the word count. Without enough trusted documents for a
    threshold all that pass the plain rules are kept. Extra columns are left alone.
    """
    found = fit(docs, labels, rules)
    rows = packed(docs, "doc_id", "text").withColumn("words", words_of(F.col("text")))
    measures = base_measures(F.col("text"), F.col("words"), rules)
    rows = rows.select("doc", "doc_id", "text", "words", *[c.alias(n) for n, c in measures.items()])
    rows = rows.withColumn("weights", number_array(docs.sparkSession, found.weights))
    rows = rows.select("doc", "doc_id", "text", *measures, mean_ratio(F.col("words"), F.col("weights"), rules).alias("score"))
    good = F.lit(True) if found.threshold is None else F.col("score") >= F.lit(found.threshold)
    return rows.withColumn("base_failed", _failed(rules)).withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return unpacked(judged(docs, labels, rules).where("kept"), docs)
