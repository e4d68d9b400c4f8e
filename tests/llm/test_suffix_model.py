"""Scores of the suffix tree: against dictionaries by brute force, gains on held-out texts."""

import math
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daymill.llm import suffix_model
from daymill.llm.queries import QUERIES
from daymill.llm.suffix_model import Index, packed, sequences, tallied, unpacked, word_chunks
from daymill.session import SHUFFLE_CLEANUP, shuffles_removed
from tests.llm.helpers import SF_DIR, awkward, documents, prose


def marked(spark, rows, learn):
    df = documents(spark, [(i, t) for i, t in rows])
    return df.withColumn("training", F.expr(learn))


def check_base(rows, got, learned):
    counts, n, texts = Counter(), 0, 0
    for i, t in rows:
        if learned(i):
            words = (t or "").encode().lower().split()
            counts.update(words)
            n, texts = n + len(words) + 1, texts + 1
    kinds = len(counts) + bool(texts)
    unit = math.log10(n + kinds + 1)
    want = Counter()
    for i, t in rows:
        words = (t or "").encode().lower().split()
        base = sum(math.log10(counts[w] + 1) - unit for w in words) + math.log10(texts + 1) - unit
        want[i, len(words) + 1, sum(w in counts for w in words) + bool(texts), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0) for r in got) == want


@pytest.mark.parametrize("learn", ["doc_id % 2 = 1", "true", "false"])
def test_base_scores_are_those_of_single_counts(spark, learn):
    rows = awkward()
    got = suffix_model.score_documents(marked(spark, rows, learn), "training").collect()
    known = {"true": lambda i: True, "false": lambda i: False}.get(learn, lambda i: i is not None and i % 2 == 1)
    check_base(rows, got, known)
    assert all(r.score <= 0 for r in got)


def test_chunks_hold_the_words(monkeypatch):
    monkeypatch.setattr(suffix_model, "CHUNK_BYTES", 20)
    texts = ["A b\x0bÄ c", "", "  ", "x " * 30, "é é", "last"]
    found = [[] for _ in texts]
    for low, _, row, codes, words in word_chunks(pa.array(texts)):
        for r, c in zip(row.tolist(), codes.tolist(), strict=True):
            found[low + r].append(words[c].as_py().encode())
    assert found == [t.encode().lower().split() for t in texts]


def brute(rows, learned):
    """(id, score) by dictionaries of tuples: counts, states level by level, then every place by its longest state."""
    least, depths, prior = suffix_model.MIN_COUNT, suffix_model.DEPTH, suffix_model.PRIOR
    tokens = [("^", *(t or "").encode().lower().split(), "$") for _, t in rows]
    train = [t for t, (i, _) in zip(tokens, rows, strict=True) if learned(i)]
    if not train:
        return [(i, 0.0) for i, _ in rows]
    single = Counter(w for t in train for w in t[1:])
    unit = sum(single.values()) + len(single) + 1
    root = lambda w: (single[w] + 1) / unit
    below, levels = {((), w): root(w) for w, c in single.items() if c >= least}, []
    for depth in range(1, depths + 1):
        grams, whole = Counter(), Counter()
        for t in train:
            for at in range(depth, len(t)):
                grams[t[at - depth : at], t[at]] += 1
                whole[t[at - depth : at]] += 1
        listed = {}
        for (context, w), n in grams.items():
            if n >= least and (context[1:], w) in below:
                listed.setdefault(context, {})[w] = n
        states, kept = {}, {}
        for context, found in listed.items():
            c, own = whole[context], sum(found.values())
            rest = (c - own + prior) / (c + prior)
            p = {w: n / (c + prior) + rest * below[context[1:], w] for w, n in found.items()}
            gain = sum(n * math.log(p[w] / below[context[1:], w]) for w, n in found.items()) + (c - own) * math.log(rest)
            if gain >= suffix_model.MIN_EVIDENCE and gain >= suffix_model.MIN_DIVERGENCE * c:
                states[context] = rest
                kept |= {(context, w): x for w, x in p.items()}
        levels.append((states, kept))
        below = kept
    scores = []
    for (i, _), t in zip(rows, tokens, strict=True):
        score = 0.0
        for at in range(1, len(t)):
            p = root(t[at])
            for depth, (states, kept) in enumerate(levels[:at], 1):
                context = t[at - depth : at]
                if context not in states:
                    break
                p = kept.get((context, t[at]), states[context] * p)
            score += math.log10(p)
        scores.append((i, score))
    return scores


def check_scores(spark, rows, learn, learned):
    got = suffix_model.score_documents(marked(spark, rows, learn), "training").collect()
    rounded = lambda pairs: sorted((i is None, i or 0, round(x, 6) + 0.0) for i, x in pairs)
    assert rounded((r.doc_id, r.score) for r in got) == rounded(brute(rows, learned))
    return got


@pytest.mark.parametrize("learn", ["doc_id % 2 = 1", "true", "false"])
def test_scores_by_brute_force(spark, monkeypatch, learn):
    known = {"true": lambda i: True, "false": lambda i: False}.get(learn, lambda i: i is not None and i % 2 == 1)
    own = [(100 + k, prose(40, k % 3, 30) + " always the same ending here" * (k % 4)) for k in range(60)]
    monkeypatch.setattr(suffix_model, "CHUNK_BYTES", 3_000)
    got = check_scores(spark, awkward() + own, learn, known)
    if learn != "false":
        assert sum(r.score > r.base_score for r in got) > 40


def test_scores_of_whole_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check_scores(spark, rows, "pmod(crc32(cast(cast(doc_id as string) as binary)), 7) != 2", lambda i: crc32(str(i).encode()) % 7 != 2)


def test_a_last_token_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_model, "SHARD_PLACES", 200)
    rows = [(k, " ".join(f"the {w} of" for w in prose(30, k % 3, 20).split())) for k in range(40)]
    check_scores(spark, rows, "doc_id % 3 != 0", lambda i: i % 3 != 0)


@pytest.mark.parametrize("size", [3, 1 << 20, 1 << 30])
def test_tallied_rows(size):
    rng = np.random.default_rng(size)
    some = rng.integers(0, size, 5)
    columns = [rng.choice(some, 1_000) for _ in range(4)]
    rows, n = tallied(columns, size)
    want = Counter(zip(*(c.tolist() for c in columns), strict=True))
    assert dict(zip(zip(*(c.tolist() for c in rows), strict=True), n.tolist(), strict=True)) == want


def test_packed_columns_come_back():
    values, codes = np.array([7, 9, 11], np.uint64), np.array([2, 0, 0, 2])
    wide = np.arange(1_000) * 3
    (_, first), (_, second) = columns = unpacked(packed((values, codes), (wide, codes)))
    assert [v[c].tolist() for v, c in columns] == [[11, 7, 7, 11], [6, 0, 0, 6]]
    assert first.dtype == second.dtype == np.uint8


def test_bitmaps_hold_every_name(spark):
    names = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5_000)
    made = suffix_model.bitmap(spark.createDataFrame([(int(x),) for x in [*names, -1, 0]], "name long"), "name")
    assert made.may_have(np.append(names, [-1, 0]).view(np.uint64)).all()
    assert made.may_have(np.random.default_rng(2).integers(0, 1 << 63, 5_000).view(np.uint64)).mean() < 0.02


def test_sequences():
    token, text, since = sequences(3, np.array([0, 0, 2]), np.array([0, 1, 0]), 2)
    assert token.tolist() == [2, 0, 1, 3, 2, 3, 2, 0, 3]
    assert text.tolist() == [0] * 4 + [1] * 2 + [2] * 3
    assert since.tolist() == [0, 1, 2, 3, 0, 1, 0, 1, 2]


def test_held_out_texts_gain(spark):
    scored = QUERIES["op2_suffix_tree"](spark, SF_DIR.replace("0.001", "0.01")).toPandas()
    held = scored[scored.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (held.score > held.base_score).mean() > 0.7
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    small = QUERIES["op2_suffix_tree"](spark, SF_DIR)
    check_base(rows, small.collect(), lambda i: crc32(str(i).encode()) % 7 != 2)


def test_no_documents(spark):
    assert suffix_model.score_documents(marked(spark, [], "true"), "training").collect() == []


def test_a_gram_counts_alike_in_any_corpus(spark, monkeypatch):
    monkeypatch.setattr(suffix_model, "CHUNK_BYTES", 2_000)
    phrase = "seldom quoted passage returns"
    own = [(k, f"{phrase} x{k}") for k in range(7)]
    filler = [(100 + k, " ".join(f"w{(k * 37 + j * j) % 500}" for j in range(20_000))) for k in range(8)]
    for rows in (own + filler[:1], own + filler):
        scored = {r.doc_id: r for r in suffix_model.score_documents(marked(spark, rows, "doc_id != 0"), "training").collect()}
        assert scored[0].score > scored[0].base_score + 6


@pytest.mark.parametrize(("nodes", "words"), [(0, 300_000), (12, 20), (150, 0)])
def test_scores_beyond_the_most_frequent_nodes_and_words(spark, monkeypatch, nodes, words):
    monkeypatch.setattr(suffix_model, "HEAD_NODES", nodes)
    monkeypatch.setattr(suffix_model, "HEAD_WORDS", words)
    monkeypatch.setattr(suffix_model, "CHUNK_BYTES", 3_000)
    own = [(100 + k, prose(40, k % 3, 30) + " always the same ending here" * (k % 4)) for k in range(60)]
    check_scores(spark, awkward() + own, "doc_id % 2 = 1", lambda i: i is not None and i % 2 == 1)


def test_packed_rows_stay_small_in_many_shards():
    rng = np.random.default_rng(3)
    ranks = np.arange(50_000, dtype=np.uint64) * 5
    codes = np.minimum(rng.zipf(1.3, 200_000), len(ranks)) - 1
    sizes = [sum(len(packed((ranks, codes[k::shards]), (ranks, codes[-1 - k :: -shards]))) for k in range(shards)) for shards in (4, 400)]
    assert sizes[1] < 2 * sizes[0]
    assert sizes[1] < 6 * len(codes)


def test_packed_large_and_unsorted_values_come_back():
    big = np.sort(np.random.default_rng(4).integers(0, 1 << 63, 300, dtype=np.uint64)) * np.uint64(2)
    columns = [(np.append(np.arange(5, dtype=np.uint64), big), np.arange(305)), (np.array([5, -3, 1 << 40]), np.array([2, 1, 1])), (big[:0], np.zeros(0, np.int64))]
    for (values, codes), (got, at) in zip(columns, unpacked(packed(*columns)), strict=True):
        assert got.dtype == values.dtype and got[at].tolist() == values[codes].tolist()


@pytest.mark.parametrize("size", [0, 1, 5_000])
def test_index_finds_names(size):
    names = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    asked = np.concatenate([names, names - np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    at, known = Index(names).find(asked)
    assert known.tolist() == np.isin(asked, names).tolist()
    assert (names[at[known]] == asked[known]).all()


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f.name() for f in map(blocks.getAllBlocks().apply, range(blocks.getAllBlocks().size())) if f.isShuffle()}
    before = shuffles()
    with shuffles_removed(spark):
        spark.range(1_000).repartition(5, "id").write.parquet(str(tmp_path / "rows"))
        for _ in range(50):
            if not (left := shuffles() - before):
                break
            time.sleep(0.2)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1_000
