"""Packing: nothing lost, gapless sequences, ids that agree with the library, and few sequences."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reelhouse.llm import packing as p
from reelhouse.llm.tokens import WordEncoder


def best(items, room):
    """The fewest bins, by trying everything."""
    items, found = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= found[0]:
            return
        if i == len(items):
            found[0] = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] >= items[i]:
                bins[k] -= items[i]
                go(i + 1, bins)
                bins[k] += items[i]
        go(i + 1, [*bins, room - items[i]])

    go(0, [])
    return found[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plan_is_whole_and_as_short_as_can_be(items):
    plan = p.complete_bins(Counter(items), p.Packing(length=20))
    used = Counter()
    for filling, times in plan:
        assert sum(size * n for size, n in filling) <= 20
        for size, n in filling:
            used[size] += n * times
    assert used == Counter(items)
    assert p.fewest(Counter(items), 20) <= sum(n for _, n in plan) == best(items, 20)


def plain_best_fit(items, room):
    """Best-fit decreasing, piece by piece."""
    bins = []
    for x in sorted(items, reverse=True):
        fitting = [b for b in bins if b >= x]
        if fitting:
            bins.remove(min(fitting))
            bins.append(min(fitting) - x)
        else:
            bins.append(room - x)
    return len(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60))
def test_best_fit_by_groups_is_best_fit_by_pieces(items):
    plan = p.best_fit(Counter(items), 60)
    used = Counter()
    for filling, times in plan:
        assert sum(size * n for size, n in filling) <= 60
        for size, n in filling:
            used[size] += n * times
    assert used == Counter(items) and sum(n for _, n in plan) == plain_best_fit(items, 60)


@pytest.mark.parametrize("low, high", [(1000, 2100), (1, 4097), (200, 1500), (1300, 1400), (900, 3000)])
def test_never_more_than_best_fit(low, high):
    rng = random.Random(low)
    for i in range(40):
        counts = Counter(rng.randrange(low, high) for _ in range(rng.choice([50, 300, 3000])))
        if i % 2:
            counts = Counter({size: n * rng.randrange(1, 10**6) for size, n in counts.items()})
        plan = p.complete_bins(counts, p.Packing(nodes=300, splits=3))
        bins = sum(n for _, n in plan)
        assert p.fewest(counts, 4096) <= bins <= sum(n for _, n in p.best_fit(counts, 4096))
        if not i % 2:
            assert bins <= plain_best_fit(counts.elements(), 4096)
        used = Counter()
        for filling, times in plan:
            assert sum(size * n for size, n in filling) <= 4096
            for size, n in filling:
                used[size] += n * times
        assert used == counts


def test_short_pieces_are_kept_for_middling_ones():
    """Of lengths from a quarter to a half, full pairs of the longest leave no triples; best fit is 5 % above what is found."""
    rng = random.Random(1)
    counts = Counter(rng.randrange(1000, 2100) for _ in range(3000))
    found = sum(n for _, n in p.complete_bins(counts, p.Packing(nodes=100)))
    assert found <= 0.96 * sum(n for _, n in p.best_fit(counts, 4096)) and found <= 1.06 * p.fewest(counts, 4096)


def test_search_goes_beyond_the_first_descent():
    """The fullest completion of the first piece is not part of any best packing here."""
    items = [6, 6, 4, 4, 3, 3, 2, 2]
    assert sum(n for _, n in p.complete_bins(Counter(items), p.Packing(length=10))) == 3
    assert p.complete_bins({}, p.Packing()) == []


@pytest.mark.parametrize("copies", [1, 5, 10**6])
def test_fillings_that_pass_over_a_fitting_length(copies):
    """Two exactly full sequences exist, but the longest piece that fits is in neither of them."""
    pieces = [2457, 778, 451, 410, 2253, 737, 573, 533]
    plan = p.complete_bins(dict.fromkeys(pieces, copies), p.Packing())
    assert sum(n for _, n in plan) == 2 * copies


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=7), st.integers(1, 20))
def test_all_undominated_fillings_and_no_others(items, room):
    def totals(own):
        """Total and number of pieces of each choice of some pieces."""
        found = {(0, 0)}
        for x in own:
            found |= {(t + x, n + 1) for t, n in found}
        return found

    def dominated(own):
        free = Counter(items) - Counter(own)
        return any(x > t or (x == t and n > 1) for t, n in totals(own) for x in free if t <= x <= t + room - sum(own))

    choices = {tuple(sorted(c)) for n in range(len(items) + 1) for c in combinations(items, n)}
    expected = {c for c in choices if sum(c) <= room and not dominated(c)}
    found = list(p._Stock(Counter(items), room).fillings(room, lambda: room))
    assert found[0] is not None
    found = [tuple(sorted(x for x, n in f for _ in range(n))) for f in found if f is not None]
    assert len(found) == len(set(found)) and set(found) == expected
    assert [sum(f) for f in found] == sorted(map(sum, found), reverse=True)


def test_many_of_few_lengths():
    plan = p.complete_bins({4096: 10**9, 1000: 10**9, 3000: 10**9, 96: 10**9}, p.Packing())
    assert sum(n for _, n in plan) == 2 * 10**9


def check(rows, length):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by)


def test_documents(small, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    packing = p.Packing(length=512)
    rows = p.pack_documents(small["documents"], tokenizer, packing, with_ids=True).collect()
    n = check(rows, 512)
    assert n <= 1.01 * sum(r.length for r in rows) / 512 + 1
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    docs = small["documents"].collect()
    assert len(by) == len(docs)
    for d in docs:
        own = sorted(by[d.doc_id], key=lambda r: r.piece)
        ids = library.encode(d.text, add_special_tokens=False).ids + [1]
        assert [r.start for r in own] == list(range(0, len(ids), 512))
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length for r in own)


@pytest.mark.parametrize("text", ["", "a<|endoftext|>b c", "É é", "\x1cx\x1f y\x85z", "I'll 'S 12.5", "İstanbul ΣΑΣ", "日本 😀😀a", "\x00 a\x00", "́ a  b"])
def test_words_give_the_ids_of_the_whole_text(tokenizer, text):
    library, encoder = Tokenizer.from_file(tokenizer), WordEncoder.of(tokenizer)
    (data,) = encoder.encode([text.encode()])
    assert np.frombuffer(data, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_edge_rows(edge_docs, no_docs, tokenizer):
    rows = p.pack_documents(edge_docs, tokenizer).collect()
    check(rows, 4096)
    assert sum(r.piece == 0 for r in rows) == 14
    assert p.pack_documents(no_docs, tokenizer).count() == 0
