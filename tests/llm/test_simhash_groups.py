"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash

from daymill.llm import simhash_groups
from daymill.llm.simhash_groups import Forest, block_choices, fingerprint
from tests.llm.helpers import awkward, collected, documents, prose


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius):
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(prints):
            for b, y in enumerate(prints):
                if (x ^ y).bit_count() <= radius:
                    label[a] = label[b] = min(label[a], label[b])
    ids = {}
    for k, (i, _) in zip(label, rows, strict=True):
        ids[k] = min((x for x in (ids.get(k), i) if x is not None), default=None)
    return [(i, p, ids[k]) for (i, _), p, k in zip(rows, prints, label, strict=True)]


@pytest.mark.parametrize("text", ["", "A b", "a b c d", "x " * 99, prose(500, 3)])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 4) == plain_fingerprint(text)


def test_forest_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 12).astype(np.uint64)
    near = [c ^ np.uint64(1 << int(a) | 1 << int(b)) for c in centres for a, b in rng.integers(0, 64, (15, 2))]
    fps = np.unique(np.concatenate([centres, np.array(near, np.uint64)]))
    fps = rng.permutation(fps)
    starts = np.array([0, 40, 41, len(fps)])
    forest = Forest(fps, starts)
    for tree in range(3):
        own = np.arange(starts[tree], starts[tree + 1])
        q, node = forest.search(fps, np.full(len(fps), forest.roots[tree]), 4)
        want = {(a, b) for a in range(len(fps)) for b in own.tolist() if int(fps[a] ^ fps[b]).bit_count() <= 4}
        assert set(zip(q.tolist(), node.tolist(), strict=True)) == want


@pytest.mark.parametrize("nodes", [10, 10**7, 10**10])
def test_blocks_share_a_choice(nodes):
    choices = block_choices(nodes, 4)
    for _ in range(200):
        flips = sum(1 << int(b) for b in np.random.default_rng().choice(64, 4, replace=False))
        assert any(flips & c == 0 for c in choices)


def rows_of(seed):
    base = prose(400, seed)
    close = [(50 + k, " ".join([*base.split()[:390], *prose(2, k).split(), *base.split()[392:]])) for k in range(12)]
    return awkward(seed) + close + [(90, base.upper()), (91, prose(3, 5))]


@pytest.mark.parametrize("tree_nodes", [1024, 2])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, tree_nodes):
    monkeypatch.setattr(simhash_groups, "TREE_NODES", tree_nodes)
    rows = rows_of(1)
    got = collected(simhash_groups.group_documents(documents(spark, rows), radius=10), "doc_id", "fp")
    want = sorted(plain_groups(rows, 10), key=lambda r: (r[0] is None, r[0] or 0, r[1] - (r[1] >> 63 << 64)))
    assert [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got] == want


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, prose(50, 1)), (3, prose(50, 1)), (None, "a b c d e"), (4, None), (5, "")]
    kept = simhash_groups.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, None]


def test_no_documents(spark):
    assert simhash_groups.group_documents(documents(spark, [])).collect() == []
    assert simhash_groups.keep_one(documents(spark, [])).collect() == []
