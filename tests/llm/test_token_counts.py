"""Token counts against the library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reelhouse.llm import token_counts as c
from reelhouse.llm.queries import op12_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
NASTY = ["a", "word", " ", "  ", "\n", " \n ", "\t", "'", "'re", "'ll", "ll", "12", "é", "😀", "日本", "<|endoftext|>", "<|endof", "text|>", "!!", "|>", "\xa0", "\u3000", "\u180e", "\u200b", "\x1c", "\x00", "İ", "ab" * 9]
TEXTS = st.lists(st.sampled_from(NASTY), max_size=60).map("".join)


def tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_counts_by_parts(text):
    assert c.Counter.of(PATH).counts([text, text + " x"]) == [tokens(text), tokens(text + " x")]


@settings(max_examples=500, deadline=None)
@given(TEXTS, st.integers(0, 200), st.integers(0, 200))
def test_common_boundaries_are_boundaries_of_the_whole(text, start, end):
    """Two overlapping parts, the first from the start: any common boundary before the margin splices them exactly."""
    counter = c.Counter.of(PATH)
    left, right = text[: max(end, start)], text[start:]
    _, at, before = counter.boundaries(left)
    n, right_at, right_before = counter.boundaries(right)
    after = dict(zip((right_at + start).tolist(), right_before.tolist()))
    for place, count in zip(at.tolist(), before.tolist()):
        if place in after and place <= len(left) - counter.margin:
            assert count + n - after[place] == tokens(text)


@pytest.mark.parametrize("how", [c.Counting(chunk=64, overlap=24), c.Counting(chunk=200, overlap=90)])
def test_huge_texts(spark, how):
    """Texts of many chunks, with passages that no overlap can splice."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(NASTY) for _ in range(rng.randrange(400))) for _ in range(150)]
    texts += ["a" * 1000, "x " + "b" * 700 + " y " * 50, " " * 500 + "z", "<|endoftext|>" * 40, "é" * 333, "ab " * 300]
    texts += [a + " " + b for a, b in zip(texts, texts[1:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in c.token_counts(docs, PATH, how).collect()}
    assert found == {i: (len(t.encode()), tokens(t), tokens(t) > 512) for i, t in enumerate(texts)}


def test_query(spark, folder, small):
    rows = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op12_token_counts(spark, folder).collect()}
    docs = small["documents"].collect()
    assert len(rows) == len(docs)
    assert rows == {d.doc_id: (len((d.text or "").encode()), tokens(d.text), tokens(d.text) > 512) for d in docs}


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert c.Counter.of(path).margin is None
    docs = spark.createDataFrame([(1, "Some words here " * 50)], "doc_id long, text string")
    (row,) = c.token_counts(docs, path, c.Counting(chunk=64, overlap=24)).collect()
    assert row.n_tokens == len(Tokenizer.from_file(path).encode("Some words here " * 50, add_special_tokens=False).ids)


def test_edge_rows(edge_docs, no_docs):
    rows = sorted((str(r.doc_id), tokens(r.text)) for r in edge_docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in c.token_counts(edge_docs, PATH).collect()) == rows
    assert c.token_counts(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        c.Counting(chunk=10, overlap=5)
