"""Line dedup against its SQL, and a state that insertions and deletions change and restore."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from daymill.llm import line_dedup
from daymill.llm.line_dedup import Cuckoo, filter_of, line_key, load
from tests.llm.helpers import awkward, collected, documents


def plain(rows):
    """Texts after dropping lines that a smaller doc_id holds, for rows in order."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                owner[key(line)] = min(owner.get(key(line), i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or owner.get(key(x), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


ROWS = [
    (5, "Shared line here\nonly mine, really\nshort"), (2, "  shared LINE here\t\nshort\nshared line here"), (9, "ÄÖÜ shared line\nshared line here\n"),
    (7, "äöü shared line\nonly mine, too long"), (7, "äöü shared line\nonly mine, too long"), (None, "shared line here"), (3, None), (4, ""), (1, "\n\n"),
    (11, "ééééééééé"), (12, "ééééééééé"), (13, "éééééééééé"), (14, "éééééééééé"),
]


def answer(df):
    return sorted(((r.row.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_lines_of_others_go(spark):
    for rows in (ROWS, awkward()):
        got = line_dedup.dedup(documents(spark, rows))
        assert answer(got) == sorted(plain(rows), key=str)
        assert got.select("row.*").columns == documents(spark, rows).columns


def test_batches_and_deletions_are_reversible(spark):
    first, second = ROWS[:5], [(20, "Only mine, REALLY\nnew line of twenty"), (0, "shared line here\nnew line of twenty")]
    docs = [documents(spark, rows) for rows in (first, second)]
    state = line_dedup.insert(line_dedup.empty_state(spark, 3), docs[0])
    before = collected(state.refs, "hi", "lo")
    both = line_dedup.insert(state, docs[1])
    assert answer(line_dedup.drop_lines(docs[0].union(docs[1]), both)) == sorted(plain(first + second), key=str)
    back = line_dedup.delete(both, docs[1], docs[0])
    assert collected(back.refs, "hi", "lo") == before
    again = line_dedup.insert(back, docs[1])
    assert collected(again.refs, "hi", "lo") == collected(both.refs, "hi", "lo")
    empty = line_dedup.delete(line_dedup.delete(again, docs[0], docs[1]), docs[1], docs[0].limit(0))
    assert empty.refs.collect() == []
    for row in empty.filters.collect():
        assert not load(row.payload).table.any()


def test_removing_the_owner_names_the_next(spark):
    rows = [(1, "a line to share"), (2, "a line to share"), (3, "a line to share")]
    state = line_dedup.insert(line_dedup.empty_state(spark, 2), documents(spark, rows))
    less = line_dedup.delete(state, documents(spark, rows[:1]), documents(spark, rows[1:]))
    assert [(r.refs, r.owner) for r in less.refs.collect()] == [(2, 2)]


keys = st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=300, unique=True).map(lambda x: np.array(x, np.int64))


@settings(max_examples=50, deadline=None)
@given(keys=keys)
def test_filters_never_forget(keys):
    lo = keys * 31 + 7
    made = load(filter_of(keys, lo).table.tobytes())
    assert made.contains(keys, lo).all()
    assert made.delete(keys, lo).all() and not made.table.any()


def test_few_strangers_look_known():
    rng = np.random.default_rng(5)
    made = filter_of(*rng.integers(-(2**62), 2**62, (2, 3000)))
    assert made.contains(*rng.integers(-(2**62), 2**62, (2, 5000))).mean() < 0.01


def colliding():
    """Two lines that one small filter cannot tell apart."""
    met = {}
    for k in range(100_000):
        line = f"line number {k}"
        hi, lo = np.frombuffer(line_key(line.encode()), np.int64)[:, None]
        mark, a, b = Cuckoo.for_keys(1).places(hi, lo)
        name = (int(mark[0]), *sorted((int(a[0]), int(b[0]))))
        if name in met:
            return met[name], line
        met[name] = line


def test_lines_of_one_fingerprint_keep_their_own_entries(spark):
    a, b = colliding()
    first, second, third = ([(i, t)] for i, t in ((1, a), (2, b), (3, a)))
    docs = [documents(spark, rows) for rows in (first, second, third)]
    state = line_dedup.empty_state(spark, 1)
    for d in docs[:2]:
        state = line_dedup.insert(state, d)
    assert np.count_nonzero(load(state.filters.first().payload).table) == 2
    state = line_dedup.insert(line_dedup.delete(state, docs[1], docs[0]), docs[2])
    assert [(r.refs, r.owner) for r in state.refs.collect()] == [(2, 1)]
    assert answer(line_dedup.drop_lines(docs[0].union(docs[2]), state)) == sorted(plain(first + third), key=str)


def test_a_full_filter_is_made_anew(spark):
    batches = [[(10 * k + j, "\n".join(f"batch {k} row {j} line {n}" for n in range(60))) for j in range(3)] for k in range(3)]
    state = line_dedup.empty_state(spark, 1)
    for rows in batches:
        state = line_dedup.insert(state, documents(spark, rows))
    made = load(state.filters.first().payload)
    assert np.count_nonzero(made.table) == state.refs.count() == 540
    hi, lo = (np.array([r[c] for r in state.refs.collect()]) for c in ("hi", "lo"))
    assert made.contains(hi, lo).all()


def test_later_batches_ask_the_filters(spark, monkeypatch):
    asked = []
    through = line_dedup._through_filters

    def counted(state, keys, change, label):
        out = through(state, keys, change, label)
        if change is line_dedup._ask:
            asked.append(out.filter("answer").count())
        return out

    monkeypatch.setattr(line_dedup, "_through_filters", counted)
    rows = [(k, "one line for everybody\nand a second one") for k in range(20)]
    assert answer(line_dedup.dedup(documents(spark, rows), batches=3)) == sorted(plain(rows), key=str)
    assert asked[0] == 0 and asked[-1] == 2


def test_insert_undoes_itself_when_full():
    f = Cuckoo.for_keys(1)
    hi = np.arange(500)
    assert not f.insert(hi, hi << 48) and not f.table.any()


def test_no_documents(spark):
    assert line_dedup.dedup(documents(spark, [])).collect() == []
