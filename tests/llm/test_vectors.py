"""Clusters and codes of vectors against plain rounds over all points, and against SQL."""

import hashlib
from types import SimpleNamespace

import numpy as np
import pytest

from daymill.llm import clustering, compression
from daymill.llm.queries import ORACLES, QUERIES
from daymill.llm.vectors import gap, largest_other, nearest
from tests.llm.helpers import SF_DIR, collected
from tests.oracle import differences

SCHEMA = "vec_id long, embedding array<double>, label int, v string, cluster string, was int, key int, code string, copy int"
CLASHING = ("x", "y", 1, 2, "z", 3)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA).repartition(3)


def blobs(n, dim, seed, ids=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, dim))
    points = centres[rng.integers(0, 6, n)] + rng.normal(0, 0.15, (n, dim))
    return [(ids + i, [float(x) for x in p], int(i % 3)) for i, p in enumerate(points)]


def awkward(dim):
    rows = blobs(300, dim, 1)
    bad = [(1001, None, 1), (1002, [float("nan")] * dim, 1), (1003, [None] * dim, 1), (1004, [float("inf")] + [0.0] * (dim - 1), 1), (1005, [], 1)]
    odd = [(None, rows[3][1], None), (7, rows[7][1], None), (7, rows[8][1], 2), *[(2000 + k, rows[0][1], 0) for k in range(40)]]
    return rows + bad + odd


def plain_rounds(v, points, rounds):
    """Assignments and points after so many rounds, everything compared with everything."""

    def assign():
        return [min(range(len(points)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(x, points[c], strict=True)), c)) for x in v]

    for _ in range(rounds):
        places = assign()
        for c in range(len(points)):
            own = [x for x, p in zip(v, places, strict=True) if p == c]
            if own:
                points[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return assign(), points


def whole(rows, scale, dim):
    kept = [(i, x, label) for i, x, label in rows if x and len(x) == dim and all(c is not None and np.isfinite(c) for c in x)]
    return [(i, [int(np.floor(c * scale)) for c in x], label) for i, x, label in kept]


def far(x, y):
    return sum((a - b) ** 2 for a, b in zip(x, y, strict=True))


def joined(numbers):
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_clusters_are_those_of_plain_rounds(spark, rounds):
    rows = awkward(8)
    kept = whole(rows, 64, 8)
    starts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:5]
    places, points = plain_rounds([r[1] for r in kept], [r[1] for r in starts], rounds)
    got = clustering.cluster(vectors(spark, rows), dim=8, k=5, rounds=rounds)
    distances = [far(r[1], points[p]) for r, p in zip(kept, places, strict=True)]
    inertia = [sum(d for d, p in zip(distances, places, strict=True) if p == c) for c in range(5)]
    want = [(r[0], p, d, inertia[p], sum(inertia), joined(points[p])) for r, p, d in zip(kept, places, distances, strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_only_expired_gaps_leave_the_heap(spark, monkeypatch):
    pushed = []
    push = clustering._push

    def counted(entries, *rest):
        run = push(entries, *rest)
        pushed.append(run.count())
        return run

    monkeypatch.setattr(clustering, "_push", counted)
    rows = blobs(600, 8, 4)
    assigned, _ = clustering.heap_clusters(vectors(spark, rows), "embedding", 8, 5, 4)
    assert assigned.count() == 600
    assert pushed[0] == 600 and len(pushed) == 5
    assert pushed[-1] < 300


def test_fewer_vectors_than_points(spark):
    rows = [(3, [0.5] * 8, 1), (4, [0.5] * 8, None)]
    assert {(r.vec_id, r.cluster, r.distance) for r in clustering.cluster(vectors(spark, rows), dim=8).collect()} == {(3, 0, 0), (4, 0, 0)}
    codes = collected(compression.compress(vectors(spark, rows)), "vec_id")
    assert [(r["code"], r["error"], r["label_error"]) for r in codes] == [("00000000", 0, 0)] * 2


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [], 1), (3, [None] * 8, 1)]):
        assert clustering.cluster(vectors(spark, rows), dim=8).collect() == []
        assert compression.compress(vectors(spark, rows)).collect() == []


def test_vectors_of_another_length_have_no_code(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.5] * 4, 1), (3, [0.1] * 8, 1)]
    assert [r["vec_id"] for r in collected(compression.compress(vectors(spark, rows)), "vec_id")] == [1, 3]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(vectors(spark, [(1, [2e7] * 8, 1), (2, [-2e7] * 8, 1)]), dim=8).collect()


@pytest.mark.parametrize("rounds", [0, 4])
def test_codes_are_those_of_plain_rounds(spark, rounds):
    rows = awkward(8)
    kept = whole(rows, 1024, 8)
    starts = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:9]
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for p in range(4):
        cut = slice(2 * p, 2 * p + 2)
        places, points = plain_rounds([r[1][cut] for r in kept], [r[1][cut] for r in starts], rounds)
        books += [c for point in points for c in point]
        for n, (r, place) in enumerate(zip(kept, places, strict=True)):
            codes[n] += f"{place:02x}"
            errors[n] += far(r[1][cut], points[place])
    by_label = {label: sum(e for e, r in zip(errors, kept, strict=True) if r[2] == label) for label in (0, 1, 2, None)}
    want = [(r[0], c, e, by_label[r[2]], joined(books)) for r, c, e in zip(kept, codes, errors, strict=True)]
    got = compression.compress(vectors(spark, rows), entries=9, rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_net_displacement_is_what_counts():
    """An entry that went away and came back has moved nowhere, however far it drifted."""
    here, there = np.zeros((1, 3, 2), np.int64), np.zeros((1, 3, 2), np.int64)
    here[0, 1], here[0, 2] = (100, 0), (0, 100)
    there[0] = here[0] + [[0, 0], [0, 90], [90, 0]]
    look = {"code": np.array([[0]]), "upper": np.array([[1.0]]), "lower": np.array([[80.0]]), "upper_at": np.array([[0]]), "lower_at": np.array([[0]])}
    assert compression.History([here, there]).due(**look).tolist() == [[True]]
    assert compression.History([here, there, here]).due(**look).tolist() == [[False]]


def test_parts_whose_bounds_hold_are_not_written_again(spark):
    rows = blobs(500, 8, 4)
    runs, histories = compression.learn_codes(vectors(spark, rows), "embedding", entries=6, rounds=5)
    sizes = [run.count() for run in runs]
    assert sizes[0] == 500 and sizes[-1] < 500
    stamps = [r.lower_at for run in runs[1:] for r in run.select("lower_at").collect()]
    assert any(len(set(s)) > 1 for s in stamps)
    assert len(histories) == 6


def test_nearest_is_exact_and_first():
    rng = np.random.default_rng(3)
    points = np.concatenate([p := rng.integers(-40, 40, (5, 4)), p])
    v = rng.integers(-40, 40, (300, 4))
    place, first, second = nearest(v, points)
    d = ((v[:, None] - points[None]) ** 2).sum(-1)
    assert (place == d.argmin(1)).all() and np.allclose(first**2, d.min(1)) and (second == first).all()
    assert (gap(first, second) < 0).all()
    large = nearest(v * (1 << 22), points * (1 << 22))
    assert (large[0] == place).all()


def test_largest_other():
    assert largest_other(np.array([[3.0, 1.0, 3.0], [2.0, 5.0, 1.0]])).tolist() == [[3, 3, 3], [5, 2, 5]]
    assert largest_other(np.array([[7.0]])).tolist() == [[0]]


@pytest.mark.parametrize("name", ["op11_heap_clusters", "op13_norm_of_sum_codes"])
def test_query_against_sql(spark, name):
    assert differences(spark, SimpleNamespace(run=QUERIES[name], sql=ORACLES[name]), SF_DIR) == []
