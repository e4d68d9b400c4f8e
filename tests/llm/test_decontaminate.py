"""Leaks against a search over every window, and a plan without Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymill.llm import decontaminate
from daymill.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR, awkward, documents, prose


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def shingles(w, k=5):
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def plain(docs, items):
    """doc_id, item_id: best similarity over all windows as long as the item."""
    found = {}
    for i, t in docs:
        w = words(t)
        for item, text in items:
            v = words(text)
            if not v or not w:
                continue
            own, best = shingles(v, min(5, len(v))), 0
            for at in range(max(1, len(w) - len(v) + 1)):
                window = w[at : at + len(v)]
                there = shingles(window, min(5, len(v), len(window)))
                shared = sum((own & there).values())
                best = max(best, shared / (sum(own.values()) + sum(there.values()) - shared))
            if best >= 0.8:
                found[i, item] = max(found.get((i, item), 0), best)
    return found


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")


def planted():
    item = prose(40, 11)
    w = item.split()
    edited = [*w[:20], "changed", *w[21:]]
    inserted = [*w[:2], "new", *w[2:]]
    docs = [
        (100, prose(50, 21) + " " + item.upper() + "\n" + prose(30, 22)), (101, item), (102, " ".join(w[:38])), (103, prose(30, 1) + " " + " ".join(edited)),
        (104, " ".join(inserted)), (105, " ".join(w[:20])), (106, prose(90, 5) + " tiny item " + prose(9, 6)), (107, "a b a b a b a b a b c"), (108, item + " " + item),
    ]
    items = [(1, item), (2, "tiny item"), (3, ""), (4, None), (5, "a b a b a b a b a b d"), (6, "a b a b a b a b a b c"), (None, prose(20, 22)), (7, item), (7, prose(30, 23))]
    return docs, items


def test_every_leak_is_found(spark):
    docs, items = planted()
    docs = docs + awkward()
    got = decontaminate.leaks(documents(spark, docs), items_of(spark, items)).collect()
    want = plain(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) > 8


def test_windows_that_begin_at_no_shared_shingles_place(spark):
    """Parts of an item in another order: the window that holds both begins where neither part says."""
    a, b, edge = prose(34, 51).split(), prose(30, 52).split(), prose(40, 53).split()
    docs = [
        (1, " ".join([*edge, *b, *a, *edge])), (2, " ".join([*edge, *b, *a])), (3, " ".join([*b, *a, *edge])), (4, " ".join([*edge, *b, *edge, *a])),
        (5, " ".join([*edge, *b[:20], *a, *b[20:], *edge])), (6, " ".join([*b, *a] * 3)), (7, "a " * 90),
    ]
    items = [(1, " ".join(a + b)), (2, " ".join(b[:12] + a)), (3, "a " * 30), (4, "a a a a a b b")]
    got = decontaminate.leaks(documents(spark, docs), items_of(spark, items)).collect()
    want = plain(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert {(1, 1), (2, 1), (3, 1)} <= set(want)


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch):
    docs, items = planted()
    before = {tuple(r) for r in decontaminate.leaks(documents(spark, docs), items_of(spark, items)).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert {tuple(r) for r in decontaminate.leaks(documents(spark, docs), items_of(spark, items)).collect()} == before


def test_clean_rows_stay_as_they_are(spark):
    docs, items = planted()
    rows = docs + awkward()
    frame = documents(spark, rows)
    kept = decontaminate.clean(frame, items_of(spark, items))
    assert kept.columns == frame.columns
    bad = {i for i, _ in plain(docs, items)}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in rows if i not in bad)


def test_nothing_to_compare(spark):
    docs, items = planted()
    assert decontaminate.leaks(documents(spark, []), items_of(spark, items)).collect() == []
    assert decontaminate.leaks(documents(spark, docs), items_of(spark, [])).collect() == []
    assert decontaminate.clean(documents(spark, docs), items_of(spark, [])).count() == len(docs)


def test_fingerprints_and_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [([int(x) for x in rng.integers(-(2**63), 2**63 - 1, n)],) for n in (1, 2, 3, 30)]
    got = spark.createDataFrame(rows, "s array<long>").select("s", decontaminate.simhash(F.col("s")).alias("fp")).collect()
    for r in got:
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r.s) > len(r.s))
        assert r.fp % 2**64 == want
    a = int(rng.integers(2**62))
    b = a ^ sum(1 << int(k) for k in rng.choice(64, decontaminate.RADIUS, replace=False))
    b -= b >> 63 << 64
    cells = spark.createDataFrame([(a,), (b,)], "fp long").select(decontaminate.blocks(F.col("fp")).alias("b")).collect()
    assert set(cells[0].b) & set(cells[1].b)


@pytest.mark.parametrize("name", ["op6_simhash_windows", "op7_prefix_expansion"])
def test_no_python_on_the_way(spark, name, capsys):
    QUERIES[name](spark, SF_DIR).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
