"""Rule statistics by brute force, the forest's verdicts against labels."""

import re
from collections import Counter

import numpy as np
import pytest

from daymill.llm import isolation
from daymill.llm.isolation import Forest, statistics
from daymill.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR, awkward, documents, prose


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


TEXTS = ["", " \n ", "a b c a b c a b c", "x y é", "# $ | <a>\n# $ | <a>\n\n \n", "w " * 60, prose(200, 1)]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics(text):
    assert statistics(text.encode())[:5] == plain(text)


def test_outliers_are_isolated_sooner():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(0, 1, (2000, 3)), [[9.0, 9, 9]]])
    scores = Forest(rows).scores(rows)
    assert scores.argmax() == 2000 and scores[-1] > 0.65 > np.median(scores)
    assert Forest(rows[:0]).scores(rows[:2]).tolist() == [0.5, 0.5]
    assert len(Forest(np.ones((5, 3))).scores(np.ones((5, 3)))) == 5


def test_verdicts_on_labelled_rows(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    got = QUERIES["op3_isolation_forest"](spark, sf).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in got.itertuples():
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    passed = got[~got.base_failed & got.doc_id.isin(labels)]
    quality = passed.doc_id.map(labels)
    assert passed.kept[quality == 1].mean() >= 0.98
    assert passed.kept[quality == 0].mean() <= 0.3


def test_awkward_rows(spark):
    rows = awkward()
    labels = spark.createDataFrame([(1, None), (2, 1), (7, 0), (99, 1)], "doc_id long, quality int")
    got = isolation.judge(documents(spark, rows), labels).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, plain(t)[0]) for i, t in rows)


def test_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert isolation.judge(documents(spark, []), labels).collect() == []
    got = isolation.judge(documents(spark, [(1, prose(100, 1)), (2, None)]), labels).collect()
    assert {r.threshold for r in got} == {isolation.DEFAULT_THRESHOLD}


def lined(k, repeats=0):
    """Lines of six different words, and between them one short line ``repeats`` times."""
    lines = [" ".join(f"w{(k * 7919 + 6 * j + i) % 5003:04}" for i in range(6)) for j in range(30)]
    return "\n".join(x for j, own in enumerate(lines) for x in ([own, "again twice"] if j < repeats else [own]))


def test_repeated_short_lines_alone_are_an_anomaly(spark):
    rows = [(k, lined(k)) for k in range(300)] + [(300, lined(300, 25))]
    text = lined(300, 25).encode()
    assert statistics(text)[3:5] == (24, 0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in isolation.judge(documents(spark, rows), labels).collect()}
    assert max(got.values(), key=lambda r: r.anomaly).doc_id == 300
    assert not got[300].base_failed and not got[300].kept and got[0].kept


def test_forest_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(isolation, "ROWS_PER_TREE", 8)
    monkeypatch.setattr(isolation, "TREES", 10)
    stats = isolation.rule_statistics(documents(spark, [(k, lined(k, k % 3)) for k in range(300)] + [(7, lined(7, 1))] * 200)).persist()
    one, other = (isolation.fit(stats.repartition(n)) for n in (1, 7))
    assert one.size == 8 and len(one.trees) == 10
    for a, b in zip(one.trees, other.trees, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))
    stats.unpersist()
