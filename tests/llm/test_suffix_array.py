"""Removal of repeated byte strings against every window of every text."""

from collections import Counter
from hashlib import sha256
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daymill.llm import suffix_array
from daymill.llm.queries import ORACLES, QUERIES
from daymill.llm.suffix_array import anchors, refine, repeated_windows, window_minimum
from tests.llm.helpers import SF_DIR, awkward, documents, prose
from tests.oracle import differences

LENGTH = 40


def plain(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = True
        gone = gone[: len(t)]
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), n_spans, sha256(kept).hexdigest()))
    return Counter(out)


def check(spark, rows, length=LENGTH):
    got = suffix_array.remove_repeats(documents(spark, rows), length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(rows, length)


@settings(max_examples=100, deadline=None)
@given(pieces=st.lists(st.binary(max_size=130).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=5), length=st.sampled_from([1, 2, 5, 20, 32, 33, 50]))
def test_refined_buckets_are_equal_strings(pieces, length):
    count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
    got = [x.tolist() for x in repeated_windows(pieces, length)]
    assert got == [[i for i in range(len(p) - length + 1) if count[p[i : i + length]] > 1] for p in pieces]


def test_refine_numbers():
    data = np.frombuffer(b"abcabcab", np.uint8)
    got = refine(data, np.arange(8, 0, -1), 3)
    assert got[0] == got[3] and got[1] == got[4] and got[2] != got[0] and (got[6:] == -1).all()


def test_window_minimum():
    values = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    for width in (1, 7, 300):
        assert window_minimum(values, width).tolist() == [values[i : i + width].min() for i in range(301 - width)]


def test_every_window_belongs_to_one_stretch():
    texts = [prose(100, k).encode() for k in range(3)] + [b"", b"short", b"a" * 300]
    ends = np.cumsum([len(t) for t in texts])
    doc, _, low, high = anchors(b"".join(texts), ends, LENGTH)
    covered = [p for a, b in zip(low.tolist(), high.tolist(), strict=True) for p in range(a, b + 1)]
    starts = np.append(0, ends[:-1])
    assert covered == [p for s, t in zip(starts.tolist(), texts, strict=True) for p in range(s, s + len(t) - LENGTH + 1)]
    assert (np.diff(doc) >= 0).all()


SHARED = prose(30, 77)


def mixed_rows():
    rows = [(200 + k, prose(20 + k, k) + SHARED[k : 100 + k] + prose(15, 50 + k)) for k in range(25)]
    rows += [(300 + k, SHARED[: 60 + k] + "é" * k + SHARED[40:]) for k in range(20)]
    return rows + [(400, "ab" * 200), (401, "ab" * 100), (402, "x" * LENGTH), (403, "x" * (LENGTH - 1)), (404, prose(30, 5) * 2)]


@pytest.mark.parametrize("together", [20_000, 1])
def test_removal_is_that_of_all_windows(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_array, "TOGETHER", together)
    monkeypatch.setattr(suffix_array, "REFINED_BYTES", 2000)
    check(spark, mixed_rows())


def test_awkward_rows(spark):
    check(spark, awkward())
    check(spark, [(1, "x" * 199), (2, "x" * 200), (3, "x" * 201), (None, None)], 200)


def test_one_id_with_two_texts(spark):
    check(spark, [(1, SHARED), (1, prose(30, 1)), (2, SHARED)])


def test_no_documents(spark):
    assert suffix_array.remove_repeats(documents(spark, [])).collect() == []


def test_query_against_sql(spark):
    assert differences(spark, SimpleNamespace(run=QUERIES["op9_bucket_pointers"], sql=ORACLES["op9_bucket_pointers"]), SF_DIR) == []
