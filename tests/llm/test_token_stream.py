"""Round trips of the token stream against the tokenizers library."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daymill.llm import token_stream
from daymill.llm.queries import byte_bpe
from daymill.llm.token_stream import Coder, scale
from daymill.llm.tokenize import Encoder
from daymill.session import scratch_path
from tests.llm.helpers import awkward, documents


@pytest.fixture(scope="module")
def tokenizer():
    return byte_bpe()


@pytest.fixture(scope="module")
def encoder(tokenizer):
    return Encoder(tokenizer)


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "The", "é", "'s", "12", "$$", ".", ",", "!!", "é.", "12.", ").", "¼", "　", "\x1c", "\x85", "日本", "<|endoftext|>", " straße", " ñandú", " ǅa", " ɐb", "ª", "ʰ", " ÀÉ", "\u00ad"])


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=5))
def test_pieces_give_the_library_s_ids(encoder, texts):
    got = list(encoder.documents(pa.array(texts), 2))
    assert [g.tolist() for g in got] == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


@settings(max_examples=40, deadline=None)
@given(sizes=st.lists(st.integers(1, 1500), min_size=1, max_size=4), kinds=st.integers(1, 300), seed=st.integers(0, 99))
def test_segments_decode_each_for_itself(sizes, kinds, seed):
    rng = np.random.default_rng(seed)
    segments = [rng.integers(0, kinds, n).astype(np.uint32) for n in sizes]
    coder = Coder(scale(np.bincount(np.concatenate(segments), minlength=kinds + 3)))
    payload, marks = coder.encode(segments)
    for (at, words, states), ids in reversed(list(zip(marks, segments, strict=True))):
        assert (coder.decode(payload[4 * at : 4 * (at + words)], states, len(ids)) == ids).all()


def test_scale_keeps_every_symbol():
    counts = np.array([10**9, 1, 0, 1, 7])
    assert scale(counts, 4).tolist() == [13, 1, 0, 1, 1]
    assert scale(np.zeros(3, int)).sum() == 0
    with pytest.raises(ValueError):
        scale(np.ones(20, int), 4)


def test_size_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(1).geometric(0.05, 200_000), 500).astype(np.uint32)
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    payload, _ = Coder(scale(counts)).encode([ids])
    assert len(payload) * 8 < 1.02 * len(ids) * -(p * np.log2(p)).sum()


def test_files_give_back_all_ids(spark, tokenizer, encoder):
    rows = awkward()
    got = token_stream.write_and_describe(documents(spark, rows), tokenizer).collect()
    assert len(got) == len(rows)
    at = 0
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    want = {}
    for i, t in rows:
        ids = np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), crc32(ids.tobytes())))
    for r in order:
        assert r.start == at
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens


def test_documents_span_segments_and_blocks(spark, tokenizer, encoder, monkeypatch):
    monkeypatch.setattr(token_stream, "SEGMENT_IDS", 64)
    rows = [(i, "some words " * (i % 40)) for i in range(200)]
    path = scratch_path(spark, "test-stream")
    token_stream.write(documents(spark, rows), path, tokenizer)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_stream.read(spark, path).collect()}
    assert got == {i: [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}


def test_a_changed_stream_is_an_error(spark, tokenizer):
    path = scratch_path(spark, "test-stream")
    token_stream.write(documents(spark, [(1, "some words here")]), path, tokenizer)
    blocks = spark.read.parquet(f"{path}/blocks")
    changed = blocks.selectExpr("part", "block", "first", "payload", "transform(segments, s -> named_struct('at', s.at, 'words', s.words, 'states', s.states, 'n_ids', s.n_ids, 'crc32', s.crc32 + 1, 'doc_ids', s.doc_ids, 'doc_sizes', s.doc_sizes)) AS segments")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}-2/table")
    changed.write.parquet(f"{path}-2/blocks")
    with pytest.raises(Exception, match="checksum"):
        token_stream.read(spark, f"{path}-2").collect()


def test_no_documents(spark, tokenizer):
    assert token_stream.write_and_describe(documents(spark, []), tokenizer).collect() == []
