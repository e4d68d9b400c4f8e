"""Quality rules: an isolation forest on rule statistics, its threshold calibrated from labels."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import batch_of, binary_rows, stage, texts

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Share of repeated lines from which on published quality rules reject a text.
DUP_LINES = 0.3
TREES = 128
#: Rows a tree is grown from: the method's own subsample.
ROWS_PER_TREE = 256
#: Share of good labelled rows past the base rule that the calibrated threshold keeps, at least.
GOOD_KEPT = 0.99
#: Threshold where labels of both kinds are missing.
DEFAULT_THRESHOLD = 0.6
_EULER = 0.5772156649

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FURTHER = ("n_upper", "n_marks", "n_same", "n_lines")
_UPPER = bytes(range(65, 91))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def statistics(text: bytes) -> tuple[int, ...]:
    """COUNTS and FURTHER of a text.

    n_marks are ASCII marks, n_same words equal to the one before, n_lines lines with a word.
    """
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    joined = b"".join(words)
    less = lambda drop: len(joined) - len(joined.translate(None, drop))
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered = bytearray(n)
        for i, w in enumerate(windows):
            if counts[w] > 1:
                covered[i : i + 3] = b"\x01\x01\x01"
        repeated = sum(covered)
    return (
        n, len(joined.decode("utf-8", "replace")), less(SYMBOLS), len(lines) - len(set(lines)), repeated,
        less(_UPPER), less(_MARKS), sum(map(bytes.__eq__, words, words[1:])), len(lines),
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the statistics of every whole text; a null text has no words."""

    def run(batches):
        for batch, rows in binary_rows(batches):
            table = np.array([statistics(t) for t in rows], np.int64).reshape(-1, len(COUNTS + FURTHER))
            yield batch_of(batch, ["doc_id"], **{c: pa.array(table[:, k]) for k, c in enumerate(COUNTS + FURTHER)})

    return texts(docs).mapInArrow(run, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS + FURTHER)]))


def features(table: dict[str, np.ndarray]) -> np.ndarray:
    """Shares of the statistics, one row per document.

    Of the share of repeated lines only what is beyond DUP_LINES counts: a few repeated lines are as
    frequent in good texts as in bad ones, and rare enough for random splits to single them out.
    """
    n = np.maximum(table["n_words"], 1).astype(float)
    chars = np.maximum(table["word_chars"], 1).astype(float)
    shares = [table[c] / n for c in ("word_chars", "n_repeat_words", "n_same")]
    shares.append(np.maximum(table["n_dup_lines"] / np.maximum(table["n_lines"], 1) - DUP_LINES, 0))
    return np.column_stack(shares + [table[c] / chars for c in ("n_symbols", "n_upper", "n_marks")])


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + _EULER) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees over random splits. node arrays: feature (-1 in a leaf), cut, left child (right is the next), path."""

    def __init__(self, rows: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.size = min(ROWS_PER_TREE, len(rows))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(TREES if self.size > 1 else 0)]

    def _grow(self, rows, rng):
        limit = int(np.ceil(np.log2(max(2, len(rows)))))
        feature, cut, left, path, waiting = [-1], [0.0], [0], [0.0], [(0, rows, 0)]
        while waiting:
            at, own, depth = waiting.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(own) <= 1 or not len(usable):
                path[at] = depth + float(expected_path(len(own)))
                continue
            f = int(rng.choice(usable))
            c = rng.uniform(low[f], high[f])
            below = own[:, f] <= c
            feature[at], cut[at], left[at] = f, c, len(feature)
            for part in (own[below], own[~below]):
                waiting.append((len(feature), part, depth + 1))
                feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
        return np.array(feature), np.array(cut), np.array(left), np.array(path)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus mean path over expected path: near 1 for anomalies; 0.5 without trees."""
        if not self.trees:
            return np.full(len(rows), 0.5)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                f = np.maximum(feature[at], 0)
                at = np.where(inner, left[at] + (rows[every, f] > cut[at]), at)
            total += path[at]
        return 2 ** (-total / len(self.trees) / float(expected_path(self.size)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(stats: DataFrame, seed: int = 11) -> Forest:
    """A forest on the rows past the base rule: on all, or on about TREES * ROWS_PER_TREE of them.

    A row's hash decides whether it is drawn, so the forest does not depend on the layout of files.
    Repeated rows count once, so that they cannot exceed the bound.
    """
    passed, wanted = stats.filter(~base_failed()).select("doc_id", *COUNTS, *FURTHER), TREES * ROWS_PER_TREE
    n = passed.count()
    if n > wanted:
        place = F.pmod(F.xxhash64(F.lit(seed), *passed.columns), F.lit(1 << 32))
        passed = passed.filter(place < int(wanted / n * (1 << 32)))
    frame = passed.distinct().toPandas()
    frame = frame.sort_values(list(frame.columns))
    return Forest(features({c: frame[c].to_numpy() for c in COUNTS + FURTHER}), seed)


def add_score(stats: DataFrame, forest: Forest) -> DataFrame:
    def run(batches):
        for batch in batches:
            table = {c: np.asarray(batch.column(batch.schema.get_field_index(c))) for c in COUNTS + FURTHER}
            yield batch_of(batch, batch.schema.names, anomaly=pa.array(forest.scores(features(table))))

    return stats.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in stats.dtypes), "anomaly double"]))


def calibrate(scored: DataFrame, labels: DataFrame) -> float:
    """The threshold that drops most bad labelled rows while GOOD_KEPT of the good ones stay.

    Scores are counted in steps of 1/10000, so at most 10,001 rows come to the driver.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter("y IN (0, 1)")
    counts = (
        scored.filter(~base_failed())
        .join(known, "doc_id")
        .groupBy(F.round(F.col("anomaly") * 10_000).cast("int").alias("step"))
        .agg(F.sum(F.col("y")).alias("good"), F.sum(1 - F.col("y")).alias("bad"))
        .toPandas()
        .sort_values("step")
    )
    good, bad = counts["good"].to_numpy(float), counts["bad"].to_numpy(float)
    if not good.sum() or not bad.sum():
        return DEFAULT_THRESHOLD
    kept = np.cumsum(good) / good.sum()
    balanced = kept - np.cumsum(bad) / bad.sum()
    best = np.where(kept >= GOOD_KEPT, balanced, -1.0)
    return (float(counts["step"].iloc[int(best.argmax())]) + 0.5) / 10_000


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, anomaly score, threshold and kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word
    windows. kept is false for those, else whether the anomaly score stays below the threshold.
    Null and empty texts have zero counts and fail the base rule. Repeated rows are judged
    each; further columns are not carried.
    """
    stats = stage(rule_statistics(docs), "rule-statistics")
    scored = stage(add_score(stats, fit(stats)), "rule-scores")
    threshold = calibrate(scored, labels)
    failed = base_failed()
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("anomaly") < threshold)).alias("kept"),
        "anomaly", F.lit(threshold).alias("threshold"),
    )
