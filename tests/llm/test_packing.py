"""Bin completion against exact packings, and packed documents."""

from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from daymill.llm import packing
from daymill.llm.queries import byte_bpe
from daymill.llm.tokenize import Encoder
from tests.llm.helpers import awkward, documents


def fewest(items, capacity):
    best = len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[k]}.values():
            go(k + 1, [*rooms[:j], rooms[j] - items[k], *rooms[j + 1 :]])
        go(k + 1, [*rooms, capacity - items[k]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(items=st.lists(st.integers(1, 30), min_size=1, max_size=9), capacity=st.integers(30, 60))
def test_small_packings_are_optimal(items, capacity):
    solution = packing.pack(dict(Counter(items)), capacity)
    used = Counter()
    for pattern, times in solution:
        assert sum(length * copies for length, copies in pattern) <= capacity
        for length, copies in pattern:
            used[length] += copies * times
    assert used == Counter(items)
    assert packing.bins(solution) == fewest(items, capacity)


def test_completion_improves_on_best_fit():
    counts = dict(Counter(np.random.default_rng(3).integers(200, 500, 3000).tolist()))
    assert packing.lower_bound(counts, 1024) <= packing.bins(packing.pack(counts, 1024)) < packing.bins(packing.best_fit(counts, 1024))


def test_pieces_that_close_a_sequence_are_found():
    """Mixes where three pieces fill a sequence and best fit alone takes four sequences more."""
    counts = dict(Counter(np.random.default_rng(2).integers(250, 420, 300).tolist()))
    assert packing.bins(packing.pack(counts, 1024)) <= 100


def test_least_waste_comes_first():
    counts = {7: 2, 5: 1, 4: 3, 2: 1}
    found = list(packing.fillings(counts, 14, 14))
    waste = [14 - sum(f) for f in found]
    assert waste == sorted(waste) and waste[0] == 0 and len(set(found)) == len(found)
    assert all(max(Counter(f)[x] - c for x, c in counts.items()) <= 0 for f in found)


def test_dominated_fillings_go():
    assert list(packing.fillings({5: 1, 3: 1, 2: 2}, 5, 5)) == [(5,)]
    assert packing.fits_into((3, 2), (5,)) and not packing.fits_into((5,), (3, 2))


def check(spark, rows, capacity):
    tokenizer = byte_bpe()
    encoder = Encoder(tokenizer)
    got = packing.pack_documents(documents(spark, rows), tokenizer, capacity).collect()
    want, total = Counter(), 0
    for i, t in rows:
        ids = np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        total += len(ids)
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, piece, a, b - a, crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), -(-total // capacity)


def test_documents_are_packed_whole(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    check(spark, awkward() + [(100 + i, "word " * (i % 7)) for i in range(60)], 64)


def test_few_sequences(spark):
    n, bound = check(spark, [(i, "word " * (i % 40)) for i in range(300)], 64)
    assert n <= bound + 1


def test_no_documents(spark):
    assert packing.pack_documents(documents(spark, []), byte_bpe()).collect() == []
