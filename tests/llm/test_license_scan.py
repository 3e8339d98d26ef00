"""License scans against a scan of every phrase and every block."""

from __future__ import annotations

import random
import re

import pytest

from reelhouse.llm import license_scan as ls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    w = words(text)
    places = {}
    for phrase, label in ls.PHRASES.items():
        k = phrase.split()
        for i in range(len(w) - len(k) + 1):
            if w[i : i + len(k)] == k:
                places[i, label] = None
    base = {x for _, x in places}
    stride = max(len(t.split()) for t in [*ls.PHRASES, *ls.TEMPLATES.values()])
    labels, score = set(base), 1.0 if base else 0.0
    for first in range(0, max(len(w) - 1 - stride, 0) + 1, stride):
        block = set(w[first : first + 2 * stride])
        for label, t in ls.TEMPLATES.items():
            tokens = set(t.split())
            share = len(tokens & block) / len(tokens)
            if share >= 0.8:
                labels.add(label)
                score = max(score, share)
    starts = [i for i, _ in places]
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def same(row, text):
    expected = brute(text)
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == expected[:6]
    assert row.score == pytest.approx(expected[6])


def test_documents(small):
    docs = {r.doc_id: r.text for r in small["documents"].collect()}
    rows = ls.license_scan(small["documents"]).collect()
    assert len(rows) == len(docs) and any(r.n_base for r in rows)
    for r in rows:
        same(r, docs[r.doc_id])


CASES = [
    "Apache License apache LICENSE, the GNU General Public License: MIT-License cc.by",
    "gnu general\npublic license apache é license mit license",
    "mit " * 100 + "license " * 3,
    "filler " * 57 + ls.TEMPLATES["mit-text"] + " filler" * 80,
    " ".join(w for i, w in enumerate(ls.TEMPLATES["bsd-text"].split()) if i % 7) + " x" * 10,
    "redistribution and use " * 20,
    "This program is free software; you can redistribute it under the terms of the GNU General Public License",
    "CC BY" * 3 + " cc by cc by",
    "Kelvin apache licenſe apache license İmit license",
    None,
    "",
]


def test_cases(spark):
    rows = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for r in ls.license_scan(rows).collect():
        same(r, CASES[r.doc_id])


def test_edge_rows(edge_docs, no_docs):
    rows = ls.license_scan(edge_docs).collect()
    assert len(rows) == 14
    texts = {r.doc_id: r.text for r in edge_docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            same(r, texts[r.doc_id])
    assert ls.license_scan(no_docs).count() == 0


def test_no_python_in_the_plan(small):
    plan = ls.license_scan(small["documents"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def found_in(text, templates, threshold):
    """Labels and the best containment, trying every template on every block."""
    w, labels, score = words(text), set(), 0.0
    for label, t in templates:
        own = words(t)
        if label is None or not own:
            continue
        tokens, stride = set(own), 1
        while stride < len(own):
            stride *= 2
        least = -(-round(threshold * 1e6) * len(tokens) // 10**6)
        for first in range(0, len(w), stride):
            common = len(tokens & set(w[first : first + 2 * stride]))
            if common >= least:
                labels.add(label)
                score = max(score, common / len(tokens))
    return ",".join(sorted(labels)), pytest.approx(score)


def test_a_thousand_templates_of_the_caller(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    templates = [(f"t{i % 700}", " ".join(make(rng.choice([1, 3, 12, 40, 150])))) for i in range(1000)]
    templates += [templates[0], (None, "w1 w2"), ("empty", ""), ("null", None)]
    docs = []
    for i in range(120):
        body = make(rng.randrange(300))
        for _ in range(rng.randrange(3)):
            planted = words(templates[rng.randrange(1000)][1])
            kept = [x for x in planted if rng.random() > rng.choice([0, 0.1, 0.3])]
            at = rng.randrange(len(body) + 1)
            body[at:at] = kept
        docs.append((i, " ".join(body)))
    docs += [(200, None), (201, ""), (202, " ".join(["the"] * 5000))]
    for threshold in (0.8, 1.0):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        out = ls.templates_in(df, spark.createDataFrame(templates, "label string, text string"), ls.Scan(threshold))
        rows = {r.doc_id: (r.labels, r.score) for r in out.collect()}
        assert rows == {i: found_in(t, templates, threshold) for i, t in docs}
        assert sum(bool(x) for x, _ in rows.values()) > 50


def test_templates_of_the_caller_and_edge_rows(spark, edge_docs, no_docs):
    templates = spark.createDataFrame([("fox", "quick brown fox jumps over"), ("ab", "a b")], "label string, text string")
    rows = ls.templates_in(edge_docs, templates).collect()
    assert len(rows) == 14 and {r.labels for r in rows} == {"", "fox", "ab"}
    assert ls.templates_in(no_docs, templates).count() == 0
    none = ls.templates_in(edge_docs, templates.limit(0)).collect()
    assert len(none) == 14 and all((r.labels, r.score) == ("", 0.0) for r in none)
    plan = ls.templates_in(edge_docs, templates)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
