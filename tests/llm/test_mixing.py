"""The mix: targets by hand and by a loop, whole blocks, and the bounds on what is taken."""

from __future__ import annotations

from collections import defaultdict

import pytest

from reelhouse.llm import mixing as m


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, stop at the cap, share what is over again."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [None] * (None in sizes)
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        free = [k for k in names if k not in full]
        share = {k: left * weight[k] / sum(weight[x] for x in free) for k in free}
        over = [k for k in free if share[k] > most * sizes[k]]
        if not over:
            return full | share
        full |= {k: most * sizes[k] for k in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1, None: 5}, {"a": 7}, {"x": 5, "y": 5, "z": 5, "é": 500}, {"a": 0, "b": 3}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in m.source_targets(rows).collect()}
    assert found == pytest.approx(targets(sizes))


def check(rows, sources, block):
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        b = by[sources[r.doc_id]]
        b[0] += r.taken
        b[1], b[2] = r.source_size, r.target
    for taken, size, target in by.values():
        # The last block of the source may be short in every epoch.
        assert target - 3 * block - 1 <= taken <= target + 1
    return by


def test_documents_table(small):
    docs = small["documents"]
    sources = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    rows = m.words_taken(docs).collect()
    assert len(rows) == docs.count()
    by = check(rows, sources, 32)
    assert {k: v[2] for k, v in by.items()} == pytest.approx(targets({k: v[1] for k, v in by.items()}))
    assert sorted(m.words_taken(docs.repartition(5)).collect()) == sorted(rows)


def test_draws_are_whole(spark):
    rows = spark.createDataFrame([("a", 10_000), ("b", 900), ("c", 77)], "source string, size long")
    mix = m.Mix(block_words=10, shard_slots=100)
    sources = m.source_targets(rows, mix)
    drawn = m.draws(sources, mix).collect()
    assert sorted(r.slot for r in drawn) == list(range(len(drawn)))
    for s in sources.collect():
        own = [r for r in drawn if r.source_no == s.source_no]
        assert sum(r.words for r in own) == round(s.target)
        blocks = -(-s.source_size // 10)
        for epoch in range(max(r.epoch for r in own) + 1):
            used = [r.block for r in own if r.epoch == epoch]
            assert len(used) == len(set(used)) and all(0 <= b < blocks for b in used)
            assert epoch == max(r.epoch for r in own) or len(used) == blocks
    # A shard's counts vary as drawn ones do.
    assert len({sum(r.shard == k and r.source_no == 0 for r in drawn) for k in range(20)}) > 3


def test_mixed_documents_carry_what_is_taken(small):
    docs = small["documents"]
    mix = m.Mix(block_words=64)
    out = m.mixed(docs, mix)
    assert out.columns == docs.columns
    words, given = defaultdict(int), {r.doc_id: r for r in docs.collect()}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
        if len(r.text.split()) == len(given[r.doc_id].text.split()):
            assert r.text == given[r.doc_id].text
    taken = {r.doc_id: r.taken for r in m.words_taken(docs, mix).collect()}
    assert dict(words) == {k: v for k, v in taken.items() if v}


def test_edge_rows(edge_docs, no_docs):
    rows = m.words_taken(edge_docs).collect()
    assert len(rows) == 14 and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert m.mixed(edge_docs).columns == edge_docs.columns and m.mixed(edge_docs).count() > 0
    assert m.words_taken(no_docs).count() == 0 and m.mixed(no_docs).count() == 0
