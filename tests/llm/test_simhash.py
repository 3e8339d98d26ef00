"""SimHash groups against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import simhash as s


def groups(fingerprints, ids, max_bits):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (int(fingerprints[i]) ^ int(fingerprints[j])).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        r = root(i)
        known = [v for v in (least.get(r), x) if v is not None]
        least[r] = min(known) if known else None
    return [least[root(i)] for i in range(len(ids))]


def of(text, k=3):
    return s.majority(s.shingle_hashes((text or "").encode(), k))


def test_majority_by_hand():
    hashes = np.array([0b1011, 0b1001, 0b0001, 0b0011], np.uint64)
    assert s.majority(hashes) == 0b0001  # half is not over half
    assert s.majority(np.zeros(0, np.uint64)) == 0
    big = np.random.default_rng(1).integers(0, 1 << 64, 70_001, np.uint64)
    assert s.majority(big) == sum(1 << b for b in range(64) if 2 * int(((big >> np.uint64(b)) & np.uint64(1)).sum()) > len(big))


@pytest.mark.parametrize("leaf", [4096, 8])
def test_groups_agree_with_all_pairs(small, leaf):
    docs = small["documents"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = dict(zip([i for i, _ in rows], groups([of(t) for _, t in rows], [i for i, _ in rows], 2)))
    found = s.near_groups(docs, s.Search(leaf=leaf)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{of(t):016x}" for i, t in rows}


def test_chains_and_clusters_of_fingerprints(spark):
    """Chains that run through many shards, and a dense ball, come out whole."""
    rng = random.Random(7)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(30):
            fps.add(f)
            for _ in range(rng.choice([1, 2, 2, 3])):
                f ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(64)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(7)
    found = {r.fp: r.root for r in s.fingerprint_groups(rows, s.Search(leaf=16, depth=8)).collect()}
    expected = groups(fps, signed, 2)
    assert len(found) == len(fps)
    pairs = {(found[f], e) for f, e in zip(signed, expected)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_tree_routes_each_to_one_home_and_all_shards_in_reach():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 64, 3000, np.uint64)
    near = fps[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    everything = np.concatenate([fps, near])
    tree = s.Tree.fit(everything[::3], 5, 2)
    index, shard, home = tree.route(everything, 2)
    homes = dict(zip(index[home], shard[home]))
    assert sorted(homes) == list(range(len(everything)))
    visits = set(zip(index, shard))
    for i in range(500):
        a, b = i, 3000 + i
        later, earlier = (a, b) if homes[a] > homes[b] else (b, a)
        assert homes[a] == homes[b] or (later, homes[earlier]) in visits


def test_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    expected = sorted(zip([str(i) for i, _ in rows], [f"{of(t):016x}" for _, t in rows], map(str, groups([of(t) for _, t in rows], [i for i, _ in rows], 2))))
    found = s.near_groups(edge_docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected
    kept = s.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted({c for _, _, c in expected})
    assert s.near_groups(no_docs).count() == 0 and s.one_of_each(no_docs).count() == 0


def test_one_of_each_group_of_all_pairs(small):
    docs = small["documents"].collect()
    expected = groups([of(r.text) for r in docs], [r.doc_id for r in docs], 2)
    kept = s.one_of_each(small["documents"])
    assert kept.columns == small["documents"].columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected))


def test_rows_that_repeat_stay_once(spark):
    words = " ".join(f"w{i}" for i in range(300))
    rows = [(1, words)] * 30 + [(2, words)] * 20 + [(3, "another text altogether")] * 5 + [(None, words), (4, "one"), (4, "two words")]
    kept = s.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, words), (3, "another text altogether"), (4, "one"), (4, "two words")]
