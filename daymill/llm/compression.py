"""Vector codes by one codebook per part of the vector, learned with norm-of-sum bounds.

A part keeps two bounds from its last exact look: one on the distance to its own entry, one on that
to any other entry, each stamped with the round of the look. All codebooks so far are kept, so a
bound of round s is brought to round r by how far an entry really went from s to r, the norm of the
sum of its moves, which is at most the sum of their norms. Only parts whose bounds then cross are looked at:
first the exact distance to the own entry, and if that does not settle it, all entries.

Bounds and stamps of other parts stay as they are, so a vector is written anew only in rounds in which one
of its parts was due. The tables of all rounds together are the state: a row counts until a later round found it
due, which its own columns and the codebooks tell. Vectors never move between tasks; codebooks follow
from the sums of the parts that changed entry.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import stage
from daymill.llm.vectors import SLACK, largest_other, lists, matrix, moved_sums, nearest, to_own, whole_numbers

STATE = "vec_id long, label {label}, v array<int>, code array<int>, was array<int>, upper array<double>, lower array<double>, upper_at array<int>, lower_at array<int>"
#: Label sums up to this number are sent to all tasks.
BROADCAST_LABELS = 50_000


class History:
    """Codebooks of all rounds so far, and how far each entry is from where it was.

    ``own[s, p, j]`` is the way of entry j of part p from round s to the last round, ``other``
    the longest way among the part's other entries.
    """

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        now = books[-1].astype(np.float64)
        self.own = np.stack([np.sqrt(((now - b) ** 2).sum(-1)) for b in books]) * (1 + SLACK)
        self.other = largest_other(self.own)

    def due(self, code, upper, lower, upper_at, lower_at) -> np.ndarray:
        """Which parts' bounds cross in the last round, by row and part."""
        part = np.arange(code.shape[1])
        nearest_other = lower - self.other[lower_at, part, code]
        own = upper + self.own[upper_at, part, code]
        return nearest_other - own <= SLACK * (1 + own)


def _parts(v: np.ndarray, parts: int) -> np.ndarray:
    return v.reshape(len(v), parts, v.shape[1] // parts)


BOUNDS = (("code", np.int64), ("upper", np.float64), ("lower", np.float64), ("upper_at", np.int64), ("lower_at", np.int64))


def _look(state: dict, v: np.ndarray, history: History, due: np.ndarray) -> None:
    """Bring the parts that are due up to the last round, in place."""
    now = len(history.books) - 1
    for p in range(due.shape[1]):
        rows = np.flatnonzero(due[:, p])
        book = history.books[-1][p]
        own = np.sqrt(to_own(v[rows, p], book, state["code"][rows, p]).astype(np.float64))
        state["upper"][rows, p], state["upper_at"][rows, p] = own, now
        others = state["lower"][rows, p] - history.other[state["lower_at"][rows, p], p, state["code"][rows, p]]
        rows = rows[others - own <= SLACK * (1 + own)]
        state["code"][rows, p], state["upper"][rows, p], state["lower"][rows, p] = nearest(v[rows, p], book)
        state["lower_at"][rows, p] = now


def _written(batch, v, state: dict, was: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    pick = pa.array(rows)
    kept = {name: batch.column(batch.schema.get_field_index(name)).take(pick) for name in ("vec_id", "label")}
    ints, floats = pa.int32(), pa.float64()
    return pa.RecordBatch.from_pydict(
        kept
        | {"v": lists(v[rows], ints), "code": lists(state["code"][rows], ints), "was": lists(was[rows], ints)}
        | {c: lists(state[c][rows], floats) for c in ("upper", "lower")}
        | {c: lists(state[c][rows], ints) for c in ("upper_at", "lower_at")}
    )


def _first_look(kept: DataFrame, history: History, schema: str) -> DataFrame:
    parts = len(history.books[0])

    def run(batches):
        for batch in batches:
            v = matrix(batch, "v")
            if not len(v):
                continue
            looks = [nearest(_parts(v, parts)[:, p], history.books[0][p]) for p in range(parts)]
            state = dict(zip(("code", "upper", "lower"), (np.stack(x, 1) for x in zip(*looks, strict=True)), strict=True))
            state |= {c: np.zeros((len(v), parts), np.int64) for c in ("upper_at", "lower_at")}
            yield _written(batch, v, state, np.full_like(state["code"], -1), np.arange(len(v)))

    return stage(kept.mapInArrow(run, schema), "codes-run")


def _counting(batch, histories: list[History], written: int) -> tuple[np.ndarray, dict]:
    """The rows of a run written in round ``written`` that no later round before the last of ``histories`` found due."""
    state = {name: matrix(batch, name, kind) for name, kind in BOUNDS}
    counts = np.ones(batch.num_rows, bool)
    for history in histories[written + 1 :]:
        counts &= ~history.due(**state).any(1)
    return counts, state


def _next_look(run_: DataFrame, written: int, histories: list[History], schema: str) -> DataFrame:
    """The rows of one run that are due in the last round, looked at."""
    parts = len(histories[0].books[0])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, state = _counting(batch, histories[:-1], written)
            due = histories[-1].due(**state) & counts[:, None]
            rows = np.flatnonzero(due.any(1))
            if len(rows):
                v, was = matrix(batch, "v"), state["code"].copy()
                _look(state, _parts(v, parts), histories[-1], due)
                yield _written(batch, v, state, was, rows)

    return run_.mapInArrow(run, schema)


def learn_codes(vectors: DataFrame, column: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024):
    """The runs of all rounds and the histories of their codebooks; no runs if no vector is kept."""
    whole = whole_numbers(vectors, column, scale).select("vec_id", "label", "v")
    start = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    dim = len(start[0].v) if start else 0
    start = [r.v for r in start if len(r.v) == dim]
    if not dim or dim % parts:
        return [], []
    schema = STATE.format(label=dict(vectors.dtypes)["label"])
    book = np.ascontiguousarray(_parts(np.array(start, np.int64), parts).transpose(1, 0, 2))
    histories = [History([book])]
    runs = [_first_look(whole.filter(F.size("v") == dim), histories[0], schema)]
    sums, counts = np.zeros(book.shape, object), np.zeros(book.shape[:2], object)
    for _ in range(rounds):
        more, gained = moved_sums(runs[-1], "code", "was", book.shape)
        counts, sums = counts + more, sums + gained
        used = counts > 0
        book = book.copy()
        book[used] = (sums[used] // counts[used][:, None]).astype(np.int64)
        histories.append(History([*histories[-1].books, book]))
        looked = [_next_look(run, written, histories, schema) for written, run in enumerate(runs)]
        runs.append(stage(reduce(DataFrame.union, looked), "codes-run"))
    return runs, histories


def compress(vectors: DataFrame, column: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector.

    Kept are vectors without null or non-finite components; each component x counts as floor(scale * x).
    All vectors must have as many components as that of the smallest vec_id, a multiple of
    ``parts``: others are dropped, and an empty vector is. Rows that repeat, or share a vec_id, are vectors of
    their own; those without vec_id start no entry while others can. Ties go to the lower entry. With fewer
    than ``entries`` vectors codebooks have as many entries; without any the result is empty. Null
    labels are one label. Other columns are ignored.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "label", column)
    runs, histories = learn_codes(vectors, column, parts, entries, rounds, scale)
    label = dict(vectors.dtypes)["label"]
    if not runs:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = histories[-1].books[-1]

    def last(run_: DataFrame, written: int) -> DataFrame:
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                counts, state = _counting(batch, histories, written)
                rows = np.flatnonzero(counts)
                if not len(rows):
                    continue
                v, code = _parts(matrix(batch, "v")[rows], parts), state["code"][rows]
                error = sum(to_own(v[:, p], books[p], code[:, p]) for p in range(parts))
                pick = pa.array(rows)
                kept = {name: batch.column(batch.schema.get_field_index(name)).take(pick) for name in ("vec_id", "label")}
                yield pa.RecordBatch.from_pydict(kept | {"code": pa.array([bytes(c).hex() for c in code.tolist()], pa.string()), "error": pa.array(error, pa.int64())})

        return run_.mapInArrow(run, f"vec_id long, label {label}, code string, error long")

    coded = stage(reduce(DataFrame.union, [last(run, written) for written, run in enumerate(runs)]), "codes")
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    if by_label.count() <= BROADCAST_LABELS:
        by_label = F.broadcast(by_label)
    name = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))
