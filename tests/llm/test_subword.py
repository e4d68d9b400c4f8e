"""The subword classifier: held-out accuracy, rows it must bear."""

from collections import Counter
from zlib import crc32

import pytest

from daymill.llm import subword
from daymill.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR, awkward, documents, prose


def test_held_out_accuracy(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    got = QUERIES["op5_subword_classifier"](spark, sf).toPandas()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.itertuples())
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    held = got[got.held_out & got.doc_id.isin(labels)]
    truth = held.doc_id.map(labels)
    assert (held.predicted == truth).mean() > 0.95
    assert (held.predicted[truth == 1] == 1).mean() > 0.97


def test_scoring_is_what_the_model_says(spark):
    rows = [(i, prose(60, i)) for i in range(20)] + [(50 + i, "JUNK$$ " * 40 + prose(5, i)) for i in range(20)]
    model = subword.train([(t, int(i < 50)) for i, t in rows])
    got = {r.row.doc_id: r.score for r in subword.score(documents(spark, rows), model).collect()}
    assert all((got[i] > 0.5) == (i < 50) for i, _ in rows)
    for i, t in rows[::7]:
        used, share = subword.document_features(t.encode())
        logits = (share @ model.vectors[used]) @ model.weights + model.bias
        assert got[i] == pytest.approx(1 / (1 + 2.718281828459045 ** (logits[0] - logits[1])), abs=1e-3)


def test_awkward_rows(spark):
    rows = awkward()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 1), (8, 0), (3, 0), (6, None), (2, 5), (None, 1), (77, 0)], "doc_id long, quality int")
    got = subword.classify(docs, labels)
    assert got.select("row.*").columns == docs.columns
    assert Counter(r.row.doc_id for r in got.collect()) == Counter(i for i, _ in rows)
    none = subword.classify(docs, labels.limit(0)).collect()
    assert all(0 <= r.score <= 1 for r in none)
    assert subword.classify(documents(spark, []), labels).collect() == []


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(subword, "SAMPLE_ROWS", 3)
    rows = [(i, prose(10, i)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    chosen = subword.sample(documents(spark, rows), labels, "quality")
    assert Counter(y for _, y in chosen) == {0: 3, 1: 3}
    assert chosen == subword.sample(documents(spark, rows), labels, "quality")


def test_only_texts_that_do_not_fit_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(subword, "SAMPLE_CHARS", 100)
    rows = [(k, "long " * 40 if k % 3 == 0 else f"text {k}") for k in range(1, 10)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    learned = subword.sample(documents(spark, rows), labels, "quality")
    assert sorted(t for t, _ in learned) == sorted(t for k, t in rows if k % 3)


def test_nothing_learned_says_half(spark):
    scored = subword.score(documents(spark, [(1, "a clean text"), (2, "")]), subword.train([])).collect()
    assert [r.score for r in scored] == [0.5, 0.5]
