"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from reelhouse.llm import resampling as r

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def grams(text, runs):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, how):
    """Sorted (id, features, weight, score, rank) of rows (id, text)."""
    of = lambda text: Counter(zlib.crc32(g.encode()) % how.buckets for g in grams(text, how.runs))
    each = [of(t) for _, t in docs]
    s, t = sum(each, Counter()), sum(map(of, target), Counter())
    s_all, t_all = sum(s.values()) + how.buckets, sum(t.values()) + how.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all)))
    rows = []
    for (i, text), own in zip(docs, each):
        weight = sum(n * gain(b) for b, n in own.items())
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, sum(own.values()), weight, score, len(words(text))])
    order = sorted((x for x in rows if x[4] >= how.least_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    ranks = [(*x[:4], k + 1 if k < len(order) * how.percent // 100 else None) for k, x in enumerate(order)]
    return sorted([*ranks, *((*x[:4], None) for x in rows if x[4] < how.least_words)], key=str)


def found(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.mark.parametrize("how", [r.Resampling(), r.Resampling(runs=3, buckets=100_000, least_words=1, percent=33)])
def test_agrees_with_plain_python(small, how):
    docs = [(x.doc_id, x.text) for x in small["documents"].collect()]
    target = [x.text for x in small["benchmark"].collect()]
    assert found(r.resampled(small["documents"], small["benchmark"], how)) == brute(docs, target, how)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["Ab", "é", "😀", " ", ".", "\x00", "\n", "9", "İ", "K", "\x7f", "日本"]), max_size=30).map("".join), st.integers(1, 9))
def test_offsets_do_not_depend_on_blocks(text, size):
    data = text.encode().lower()
    found = r.word_offsets(data, r._splitter(), size)
    assert [data[a:b].decode() for a, b in found.tolist()] == words(text)


def test_drawn_are_nearer_to_the_target(spark):
    """Documents that share words with the target are drawn before others."""
    rows = [(i, " ".join(f"{'near' if i % 10 == 0 else 'far'}{(7 * i + j) % 50}" for j in range(200))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"near{j}" for j in range(50)),)] * 20, "text string")
    out = r.resampled(spark.createDataFrame(rows, "doc_id long, text string"), target).collect()
    drawn = {x.doc_id for x in out if x.rank is not None}
    assert drawn == {i for i in range(0, 400, 10)}
    assert sorted(x.rank for x in out if x.rank is not None) == list(range(1, 41))


def test_edge_rows(edge_docs, no_docs, small):
    rows = [(x.doc_id, x.text) for x in edge_docs.select("doc_id", "text").collect()]
    target = [x.text for x in small["benchmark"].collect()]
    how = r.Resampling(least_words=1, percent=100)
    assert found(r.resampled(edge_docs, small["benchmark"], how)) == brute(rows, target, how)
    assert found(r.resampled(edge_docs, no_docs, how)) == brute(rows, [], how)
    assert r.resampled(no_docs, small["benchmark"]).count() == 0
