"""The corpus pipeline, each stage against a brute-force version on its own input."""

from collections import Counter
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from daymill.llm import subword
from daymill.llm.queries import byte_bpe
from daymill.llm.tokenize import Encoder
from tests.llm.helpers import SF_DIR
from tests.llm.test_decontaminate import plain as leaks
from tests.llm.test_line_dedup import plain as fewer_lines
from tests.llm.test_simhash_groups import plain_fingerprint


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """What each stage got, and what the last one gave."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        function(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_return_documents(tables):
    assert all(t.columns == tables[0].columns and t.dtypes == tables[0].dtypes for t in tables[:5])


def test_quality(spark, tables):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = set(rows(tables[1]))
    model = subword.train(subword.sample(tables[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"), "quality"))
    assert kept == {(r.row.doc_id, r.row.text) for r in subword.score(tables[0], model).collect() if r.score >= 0.5}
    ids = {i for i, _ in kept}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) >= 0.98 * len(good)


def test_lines(tables):
    assert rows(tables[2]) == sorted((i, t) for i, t, _, _ in fewer_lines(rows(tables[1])))
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())


def test_near_copies(tables):
    before = rows(tables[2])
    prints = [plain_fingerprint(t) for _, t in before]
    label = list(range(len(before)))
    moved = True
    while moved:
        moved = False
        for a, x in enumerate(prints):
            for b, y in enumerate(prints[:a]):
                if (x ^ y).bit_count() <= 4 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    moved = True
    assert rows(tables[3]) == [r for k, r in enumerate(before) if label[k] == k]


def test_leaks(spark, tables):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before = rows(tables[3])
    known = {w for _, t in items for w in t.lower().split()}
    close = [(i, t) for i, t in before if len(known.intersection(t.lower().split())) > 5]
    bad = {i for i, _ in leaks(close, items)}
    assert rows(tables[4]) == [r for r in before if r[0] not in bad]


def test_packed(tables):
    tokenizer = Encoder(byte_bpe()).tokenizer
    want, total = Counter(), 0
    for i, t in rows(tables[4]):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        total += len(ids)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k, a, b - a, crc32(ids[a:b].tobytes())] += 1
    got = tables[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = Counter()
    for r in got:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 1024 and len(held) <= -(-total // 1024) + 1


def test_run_is_its_stages(spark, tables):
    key = ("doc_id", "piece", "length", "ids_crc32")
    assert Counter(corpus_pipeline.run(spark, SF_DIR).select(*key).collect()) == Counter(tables[5].select(*key).collect())
