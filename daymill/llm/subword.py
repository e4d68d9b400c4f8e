"""Quality classifier on supervised subword embeddings.

A word is its own hashed feature and those of its character n-grams; a word equal to the one
before it, and one that the document had before, add a feature each. Every feature has a learned
vector. A document is the mean of its features' vectors, a softmax layer gives the class, and
both are learned together by stochastic gradient descent in numpy. Documents are scored in
whole: as the layer is linear, a word's features add up to one number per class difference,
worked out for all distinct words of some texts at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from daymill.llm.common import batch_of, texts
from daymill.llm.suffix_model import word_chunks

#: Bound of the sample a model is learned from: rows per class, and characters in all.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000_000
BUCKETS = 1 << 16
DIMENSIONS = 12
EPOCHS = 8
RATE = 2.0
#: Words whose features are worked out together.
WORDS_AT_ONCE = 1 << 14
_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_SAME, _SEEN = BUCKETS, BUCKETS + 1


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bucket of each feature: all words, and their character n-grams of 2 to 4 bytes, ends marked."""
    start, end, between = (pa.scalar(x, pa.large_binary()) for x in (b"\x02", b"\x03", b""))
    marked = pc.binary_join_element_wise(start, words.cast(pa.large_binary()), end, between)
    n = len(marked)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.frombuffer(marked.buffers()[1], np.int64, n + 1)
    data = np.frombuffer(marked.buffers()[2], np.uint8, ends[-1]).astype(np.uint64)
    sizes = np.diff(ends)
    of = np.repeat(np.arange(n), sizes)
    place = np.arange(len(data)) - ends[:-1][of]
    powers = np.multiply.accumulate(np.full(sizes.max(), _BASE))
    word, name = [np.arange(n)], [np.add.reduceat(data * powers[place], ends[:-1])]
    gram = data
    for k in (2, 3, 4):
        gram = gram[:-1] * _BASE + data[k - 1 :]
        inside = np.flatnonzero(place[: len(gram)] + k <= sizes[of[: len(gram)]])
        word.append(of[inside])
        name.append(gram[inside] + np.uint64(k))
    mixed = np.concatenate(name) * _MIX
    return np.concatenate(word), ((mixed ^ (mixed >> np.uint64(31))) * _MIX >> np.uint64(40)).astype(np.int64) % BUCKETS


def word_margins(words: pa.Array, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the sum of its features' margins and their number, worked out for some words at a time."""
    value, count = np.zeros(len(words)), np.zeros(len(words), np.int64)
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = slice(at, at + WORDS_AT_ONCE)
        word, bucket = word_features(words[part])
        n = len(value[part])
        value[part], count[part] = np.bincount(word, margins[bucket], n), np.bincount(word, minlength=n)
    return value, count


def numbered(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """The number of each word of a text, and its distinct words."""
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in text.split()], np.int64)
    return numbers, pa.array(list(known), pa.large_binary())


def repeats(numbers: np.ndarray) -> tuple[int, int]:
    """Words equal to the word before, and words that came before."""
    return int((numbers[1:] == numbers[:-1]).sum()), len(numbers) - len(np.unique(numbers))


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """Per feature what it adds to logit 1 minus logit 0, before the mean; and the bias."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and the share of each."""
    numbers, words = numbered(text)
    word, bucket = word_features(words)
    total = np.bincount(bucket, np.bincount(numbers, minlength=len(words))[word], BUCKETS + 2)
    total[[_SAME, _SEEN]] = repeats(numbers)
    used = np.flatnonzero(total)
    return used, total[used] / max(1.0, total.sum())


def train(rows: list[tuple[str | None, int]], seed: int = 7) -> Model:
    """Learn from (text, label 0 or 1); with one class or none, a model that says 0.5 or that class."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 2, DIMENSIONS)),
        rng.uniform(-1, 1, (DIMENSIONS, 2)),
        np.zeros(2),
    )
    if not rows:
        return Model(np.zeros_like(model.vectors), np.zeros_like(model.weights), np.zeros(2))
    data = [(*document_features((t or "").encode()), y) for t, y in rows]
    steps = EPOCHS * len(data)
    order = np.concatenate([rng.permutation(len(data)) for _ in range(EPOCHS)]) if data else []
    for step, k in enumerate(order):
        features, share, label = data[k]
        own = model.vectors[features]
        mean = share @ own
        logits = mean @ model.weights + model.bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[label] -= 1
        rate = RATE * (1 - step / steps)
        back = model.weights @ p
        model.weights -= rate * np.outer(mean, p)
        model.bias -= 0.05 * rate * p
        # a feature's share is its step, scaled up so that rare features move at all
        model.vectors[features] = own - rate * 20 * share[:, None] * back
    return model


def smallest_hashes(keyed: DataFrame) -> DataFrame:
    """Rows (y, h) of each class below a hash that leaves its SAMPLE_ROWS smallest and few more, or all if there are no more."""
    total = dict(keyed.groupBy("y").count().collect())
    share = {y: 1.5 * SAMPLE_ROWS / n for y, n in total.items()}
    while share:
        below = F.lit(False)
        for y, part in share.items():
            below |= (F.col("y") == y) & (F.col("h") <= min((1 << 63) - 1, int(part * (1 << 64)) - (1 << 63)))
        low = keyed.filter(below)
        found = dict(low.groupBy("y").count().collect())
        short = [y for y, n in total.items() if found.get(y, 0) < min(n, SAMPLE_ROWS)]
        if not short:
            return low
        share |= {y: 2 * share[y] for y in short}
    return keyed


def sample(docs: DataFrame, labels: DataFrame, label: str) -> list[tuple[str | None, int]]:
    """At most SAMPLE_ROWS labelled whole texts per class, SAMPLE_CHARS characters in all, by hash of the id.

    A text that does not fit into what those before it left is left out alone.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    keyed = known.withColumn("h", F.xxhash64("doc_id"))
    low = smallest_hashes(keyed)
    order = Window.partitionBy("y").orderBy("h", "doc_id")
    few = low.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SAMPLE_ROWS)
    found = texts(docs).join(F.broadcast(few.select("doc_id", "y", "r")), "doc_id")  # at most SAMPLE_ROWS rows per class
    sizes = found.groupBy("r", "y", "doc_id").agg(F.sum(F.length("text")).alias("chars")).collect()
    fitting, left = [], SAMPLE_CHARS
    for s in sorted(sizes, key=lambda s: (s.r, s.y, s.doc_id)):
        if s.chars <= left:
            fitting.append((s.doc_id, s.y, s.r))
            left -= s.chars
    chosen = found.join(F.broadcast(docs.sparkSession.createDataFrame(fitting, "doc_id long, y int, r int")), ["doc_id", "y", "r"])
    rows = chosen.select("text", "y", "r").collect()
    return [(r.text, r.y) for r in sorted(rows, key=lambda r: (r.r, r.y, r.text))]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """row (a struct of all columns of ``docs``) and score, the probability of class 1, of every whole text.

    A null text counts as empty; a text without words has the score of the bias alone. Repeated
    rows each get their score.
    """
    margins, bias = model.margins()

    def run(batches):
        for batch in batches:
            column = pc.fill_null(batch.column(0).field("text").cast(pa.large_string()), "")
            scores = np.full(len(column), bias)
            for low, high, row, codes, words in word_chunks(column, lower=False):
                value, count = word_margins(words, margins)
                n = high - low
                total = np.bincount(row, minlength=n)
                same = np.bincount(row[1:][(row[1:] == row[:-1]) & (codes[1:] == codes[:-1])], minlength=n)
                seen = total - np.bincount(np.unique(row * max(1, len(words)) + codes) // max(1, len(words)), minlength=n)
                added = np.bincount(row, value[codes], n) + same * margins[_SAME] + seen * margins[_SEEN]
                scores[low:high] += added / np.maximum(1, np.bincount(row, count[codes], n) + same + seen)
            yield batch_of(batch, ["row"], score=pa.array(1 / (1 + np.exp(-np.clip(scores, -50, 50)))))

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("score", DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """row, score, predicted (1 from 0.5 up) of all documents, learned from the given labels.

    Labels that are null or neither 0 nor 1, or without a document, are left out. Repeated
    labels of one document count as often as they stand. Labels are no input of a score.
    """
    model = train(sample(docs, labels, label))
    return score(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
