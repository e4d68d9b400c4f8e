"""Mixing by systematic sampling against plain prefix sums, and against SQL."""

import hashlib
import re
from fractions import Fraction
from math import floor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from daymill.llm import mixing
from daymill.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import CLASHING, SCHEMA, SF_DIR, awkward, collected, prose
from tests.oracle import differences

WEIGHTS = (5, 2, 1)


def documents(spark, rows):
    """``rows``: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None, *CLASHING) for i, t, s in rows], SCHEMA).repartition(3)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Exact targets by sharing round after round; ``sizes``: source to words."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, full = dict.fromkeys(names, Fraction(0)), set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        shares = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(3 * sizes[s]) if s in full else Fraction(left * weight[s], shares) for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def plain_mix(rows):
    sizes = {s: sum(words(t) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    target = plain_targets(sizes)
    out = []
    for s, t in target.items():
        rate = t / sizes[s] if sizes[s] else Fraction(0)
        u = Fraction(int(hashlib.sha256(f"mix:{s or ''}".encode()).hexdigest()[:8], 16), 1 << 32)
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (words(r[1]), r[0] is not None, r[0] or 0))
        for k, (i, text, _) in enumerate(own):
            n = floor((k + 1) * rate + u) - floor(k * rate + u)
            out.append((i, s, words(text), sizes[s], float(t), n))
    return out


def sources():
    rows = [(i, t, "a") for i, t in awkward(2)]
    rows += [(100 + k, prose(20 + 7 * k, k), "b") for k in range(40)]
    rows += [(200 + k, prose(5 + k, k), None) for k in range(30)]
    rows += [(300 + k, " ", "é") for k in range(5)]
    rows += [(400 + k, prose(60, 9), "Z") for k in range(300)]
    return [*rows, (900, "one", "c"), (901, "word", "c"), (902, prose(9, 1), "")]


def test_copies_are_those_of_plain_prefix_sums(spark):
    got = mixing.copies(documents(spark, sources()))
    want = plain_mix(sources())
    assert sorted(((r.doc_id, r.source, r.size, r.source_size, r.copies) for r in got.collect()), key=str) == sorted(((*r[:4], r[5]) for r in want), key=str)
    aims = {r.source: r.target for r in got.collect()}
    assert aims == pytest.approx({r[1]: r[4] for r in want})
    assert all(r.copies <= 3 for r in got.collect())


def test_sources_come_near_their_targets(spark):
    rows = mixing.copies(documents(spark, sources())).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("longest"))
    for r in rows.collect():
        assert abs(r.taken - r.target) <= r.longest
    total = sum(words(t) for _, t, _ in sources())
    assert sum(r.target for r in rows.collect()) == pytest.approx(total)


def test_mix_emits_whole_rows_once_per_copy(spark):
    docs = documents(spark, [r for r in sources() if r[2] != "a"])
    want = {r["doc_id"]: r["copies"] for r in collected(mixing.copies(docs), "doc_id") if r["copies"]}
    mixed = mixing.mix(docs)
    assert mixed.select("row.*").columns == docs.columns
    got = mixed.groupBy("row.doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("last")).collect()
    assert {r.doc_id: r.n for r in got} == want and all(r.n == r["last"] for r in got)


def test_layout_does_not_matter(spark):
    docs = documents(spark, [r for r in sources() if r[0] is not None])
    once, again = (sorted(map(tuple, mixing.copies(d).collect()), key=str) for d in (docs, docs.repartition(7, "text")))
    assert once == again


def test_one_source_and_none(spark):
    one = mixing.copies(documents(spark, [(k, prose(10, k), "s") for k in range(9)])).collect()
    assert [(r.target, r.copies) for r in one] == [(90.0, 1)] * 9
    assert mixing.copies(documents(spark, [])).collect() == []
    assert [(r.target, r.copies) for r in mixing.copies(documents(spark, [(1, None, None), (2, "", "s")])).collect()] == [(0.0, 0)] * 2


def test_no_python_on_the_executors(spark):
    plan = mixing.copies(documents(spark, sources()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_query_against_sql(spark):
    name = "op12_systematic_mix"
    assert differences(spark, SimpleNamespace(run=QUERIES[name], sql=ORACLES[name]), SF_DIR) == []
