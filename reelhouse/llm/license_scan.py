"""License scans: an exact set-similarity join of text blocks with license templates.

A template is found in a block when the block contains enough of the template's distinct
tokens. Tokens are ordered by the number of documents they occur in, rarest first. By the
prefix filter, a block that reaches the threshold shares a token with the template's
prefix; by the length filter it has enough tokens; by the positional filter the tokens from
a match on, in that order, have to suffice. What is left is checked exactly. All texts and
all blocks take part. The few built-in notices are constants of the plan; templates of the
caller are a table of any size, joined by token. All of it is built-in column functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.operators.joins import hot_join
from reelhouse.operators.numbering import number_rows

from .common import ascii_lower, indices, pick, written

# Phrases that have to stand word by word, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Well-known license notices, and their labels.
TEMPLATES = {
    "gpl": "licensed under the gnu general public license version 3",
    "apache": "licensed under the apache license version 2 0",
    "cc": "licensed under cc by nc 4 0",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-text": "this work is licensed under a creative commons attribution international license",
    "mpl-text": "this source code form is subject to the terms of the mozilla public license",
}

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Scan:
    """``threshold`` is the share of a template's distinct tokens that a block has to contain."""

    threshold: float = 0.8


def tokens_of(text: Column) -> Column:
    """Words of a text in lower case: runs of digits, a-z and characters beyond ASCII; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NO_WORD), "")


def document_counts(texts: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many of all texts (array column ``words``) each of ``tokens`` occurs: one row per template token."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    seen = texts.select(F.explode(F.array_intersect("words", wanted)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["token"]: r["n"] for r in seen.collect()}
    return {t: counts.get(t, 0) for t in tokens}


@dataclass(frozen=True)
class Template:
    label: str
    kind: str  # "phrase" or "notice"
    text: str
    ordered: tuple[str, ...]  # distinct tokens, rarest first
    least: int  # tokens of it that a block has to contain

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.ordered[: len(self.ordered) - self.least + 1]


def templates(counts: dict[str, int], scan: Scan) -> list[Template]:
    def one(label: str, kind: str, text: str, threshold: float) -> Template:
        distinct = sorted(set(text.split()), key=lambda t: (counts[t], t))
        return Template(label, kind, text, tuple(distinct), math.ceil(threshold * len(distinct) - 1e-9))

    return [one(label, "phrase", p, 1.0) for p, label in PHRASES.items()] + [
        one(label, "notice", t, scan.threshold) for label, t in TEMPLATES.items()
    ]


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _starts(block: Column, phrase: Column) -> Column:
    """All places in ``block`` where the words of ``phrase`` stand one after the other."""
    return F.filter(indices(0, F.size(block) - F.size(phrase)), lambda i: F.slice(block, i + 1, F.size(phrase)) == phrase)


def block_matches(scanned: DataFrame, keys: list[str], counts: dict[str, int], scan: Scan = Scan()) -> DataFrame:
    """Blocks that reach a template's threshold: ``keys``, ``label``, ``kind``, ``first``, ``containment`` and ``places``.

    ``scanned`` has the columns ``keys`` and ``words``. Blocks are twice as long as the
    longest template in words and half overlap, so whatever spans no more words than a
    template lies in a block whole. ``places`` are the words, counted from 0 in the text,
    at which a phrase stands word by word. Every row of ``scanned`` also comes once
    without a match, as a null label.
    """
    known = templates(counts, scan)
    prefix = _array(sorted({t for k in known for t in k.prefix}))
    stride = max(len(k.text.split()) for k in known)
    order = _array(sorted(counts, key=lambda t: (counts[t], t)))  # the global order; other tokens cannot overlap

    last = F.greatest(F.size("words") - 1 - stride, F.lit(0))
    firsts = F.when(F.arrays_overlap("words", prefix), F.concat(F.array(F.lit(-1)), F.sequence(F.lit(0), last, F.lit(stride))))
    blocks = scanned.select(*keys, "words", F.explode(F.coalesce(firsts, F.array(F.lit(-1)))).alias("first"))
    block = F.when(F.col("first") >= 0, F.slice("words", F.col("first") + 1, F.lit(2 * stride)))
    blocks = blocks.select(*keys, "first", block.alias("block"))
    blocks = blocks.withColumn("ordered", F.array_intersect(order, "block"))
    blocks = blocks.where(F.col("block").isNull() | F.arrays_overlap("ordered", prefix))

    index = scanned.sparkSession.createDataFrame(
        [(t, p, k.label, k.kind, k.text.split(), list(k.ordered), k.least) for k in known for p, t in enumerate(k.prefix)],
        "token string, place int, label string, kind string, phrase array<string>, tokens array<string>, least int",
    )
    found = blocks.select(*keys, "first", "block", "ordered", F.posexplode_outer("ordered").alias("at", "token"))
    found = found.join(F.broadcast(index), "token", "left")  # its size is that of the templates
    enough = F.size("ordered") >= F.col("least")
    rest = F.least(F.size("tokens") - F.col("place"), F.size("ordered") - F.col("at"))
    found = found.where(F.col("block").isNull() | (enough & (rest >= F.col("least"))))
    # Exactly, and once for a block and template: at the first token they have in common.
    common = F.array_intersect("ordered", "tokens")
    found = found.withColumn("common", common)
    found = found.where(F.col("block").isNull() | ((F.get("common", F.lit(0)) == F.col("token")) & (F.size("common") >= F.col("least"))))
    places = F.transform(_starts(F.col("block"), F.col("phrase")), lambda i: i + F.col("first"))
    return found.select(
        *keys,
        "label",
        "kind",
        "first",
        (F.size("common") / F.size("tokens")).alias("containment"),
        F.when(F.col("kind") == "phrase", places).alias("places"),
    )


def _template_tokens(templates: DataFrame, threshold: float) -> DataFrame:
    """(template, label, stride, least, token) for each distinct token of each row (label, text) of ``templates``.

    ``stride`` is the template's length in words up to a power of two. Templates without a
    word or a label are left out.
    """
    words = pick(templates, "label", "text").select("label", tokens_of(F.col("text")).alias("words"))
    words = words.where((F.size("words") > 0) & F.col("label").isNotNull()).distinct()
    words = written(words.select(F.monotonically_increasing_id().alias("template"), "label", "words"), "templates")
    stride = F.expr("shiftleft(1, if(size(words) = 1, 0, length(bin(size(words) - 1))))")
    distinct = F.array_distinct("words")
    least = F.ceil(F.lit(threshold) * F.size(distinct) - 1e-9).cast("int")
    return words.select("template", "label", stride.alias("stride"), least.alias("least"), F.explode(distinct).alias("token"))


def containments(scanned: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """(row, label, containment) for texts with a block that contains a template's share ``threshold`` of tokens.

    ``scanned`` has a unique ``row`` and ``words``. A template is sought in blocks of twice
    its length in words, up to a power of two, of which half overlap. Only words that some
    template has are joined; nothing but what Spark measures as small is broadcast, and a
    word with a third of all places is split over tasks. Repeated templates count once.
    """
    tokens = written(_template_tokens(templates, threshold), "template-tokens")
    hits = scanned.select("row", F.posexplode("words").alias("at", "token"))
    known = tokens.select("token").distinct()
    hits = written(hot_join(hits, known, ["token"], "left_semi"), "template-words")
    # The global order: in how few texts a token occurs. Tokens in no text come first, and match nothing.
    counts = hits.select("row", "token").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = known.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    ranked = written(number_rows(ranked, ["n", "token"], name="rank", unique=True).select("token", "rank"), "token-ranks")
    ordered = tokens.join(ranked, "token").groupBy("template", "label", "stride", "least").agg(F.sort_array(F.collect_list("rank")).alias("tokens"))
    ordered = written(ordered, "template-index")
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - F.col("least") + 1)
    index = ordered.select("*", F.posexplode(prefix).alias("place", "rank"))
    # Each word goes to the two blocks it lies in, for every stride at which a template has it.
    of_stride = tokens.join(ranked, "token").groupBy("token", "rank").agg(F.collect_set("stride").alias("strides"))
    placed = hot_join(hits, of_stride, ["token"]).select("row", "at", "rank", F.explode("strides").alias("stride"))
    block = F.floor(F.col("at") / F.col("stride"))
    placed = placed.select("row", "rank", "stride", F.explode(F.array(block, block - 1)).alias("block")).where("block >= 0")
    blocks = placed.groupBy("row", "stride", "block").agg(F.sort_array(F.collect_set("rank")).alias("ordered"))
    found = blocks.select("row", "stride", "block", "ordered", F.posexplode("ordered").alias("at", "rank"))
    found = found.join(index, ["rank", "stride"])
    rest = F.least(F.size("tokens") - F.col("place"), F.size("ordered") - F.col("at"))
    found = found.where((F.size("ordered") >= F.col("least")) & (rest >= F.col("least")))
    # Exactly, and once for a block and template: at the first token they have in common.
    found = found.withColumn("common", F.array_intersect("ordered", "tokens"))
    found = found.where((F.get("common", F.lit(0)) == F.col("rank")) & (F.size("common") >= F.col("least")))
    return found.groupBy("row", "label").agg(F.max(F.size("common") / F.size("tokens")).alias("containment"))


def templates_in(docs: DataFrame, templates: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``doc_id``, ``labels`` (distinct, sorted, comma-joined) and ``score`` of every row of ``docs``.

    The labels of those of ``templates`` (label, text) that a block of the text contains.
    Null and empty texts have none; repeated rows and null ids each stay; without templates
    every row has no label and score 0.
    """
    rows = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", tokens_of(F.col("text")).alias("words"))
    rows = written(rows, "words")
    found = containments(rows, templates, scan.threshold).groupBy("row").agg(
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("containment").alias("score")
    )
    joined = rows.select("row", "doc_id").join(found, "row", "left")
    return joined.select("doc_id", F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def license_scan(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score``.

    One row per row of ``docs``, repeated rows and null ids included; a null text counts as
    empty. Phrases and notices both come from the join; a phrase counts where its words
    also stand one after the other. ``score`` is the largest containment found, 1 for a
    phrase, 0 without any.
    """
    scanned = pick(docs, "doc_id", "text").withColumn("words", tokens_of(F.col("text")))
    tokens = sorted({t for text in [*PHRASES, *TEMPLATES.values()] for t in text.split()})
    counts = document_counts(scanned, tokens)
    keys = ["row", "doc_id", "n_words"]
    scanned = scanned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), "words"
    )
    phrase = (F.col("kind") == "phrase") & (F.size("places") > 0)
    per_place = F.when(phrase, F.transform("places", lambda p: F.struct(p.alias("place"), F.col("label").alias("label"))))
    rows = block_matches(scanned, keys, counts, scan).groupBy(*keys).agg(
        F.array_distinct(F.flatten(F.collect_list(per_place))).alias("base"),
        F.collect_set(F.when(F.col("kind") == "notice", F.col("label"))).alias("notices"),
        F.max(F.when(phrase, F.lit(1.0)).when(F.col("kind") == "notice", F.col("containment"))).alias("score"),
    )
    base_labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    places = F.transform("base", lambda b: b["place"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, "notices")), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
