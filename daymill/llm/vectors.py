"""Whole-number vectors, their exact nearest points, and means from moved vectors only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows compared with all points in one step.
ROWS_AT_ONCE = 8192
#: Share by which float bounds are widened, far above their rounding error.
SLACK = 1e-9


def whole_numbers(df: DataFrame, column: str, scale: int, dim: int | None = None) -> DataFrame:
    """Rows whose vector has ``dim`` components, none null or non-finite, beside ``v``: floor(scale * x) of each.

    Components must fit an int; a larger one is an error, as squared distances would not fit a long.
    """
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = df.filter(F.col(column).isNotNull() & ~bad)
    if dim is not None:
        kept = kept.filter(F.size(column) == dim)
    return kept.withColumn("v", F.transform(x, lambda c: F.floor(c * scale)).cast("array<int>"))


def matrix(batch: pa.RecordBatch, column: str, kind=np.int64) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A matrix as a list column."""
    bounds = np.arange(0, values.size + 1, max(values.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.reshape(-1), kind))


def squared(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` and of ``points``, as whole numbers in a matrix."""
    far = int(max(np.abs(v).max(initial=0), np.abs(points).max(initial=0)))
    reach = v.shape[1] * (2 * far) ** 2
    if reach < 1 << 53:  # every partial sum is a whole number that a double holds
        a, b = v.astype(np.float64), points.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    if reach >= 1 << 63:
        raise ValueError(f"components up to {far} are too large for squared distances as longs")
    return np.stack([((v - p) ** 2).sum(1) for p in points], axis=1)


def nearest(v: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of ``v`` its nearest point (ties: the first), the distance to it and to the nearest other one.

    Without another point that distance is infinite.
    """
    place, first, second = np.zeros(len(v), np.int64), np.zeros(len(v)), np.full(len(v), np.inf)
    for at in range(0, len(v), ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        d = squared(v[part], points)
        row = np.arange(len(d))
        place[part] = d.argmin(1)
        first[part] = np.sqrt(d[row, place[part]])
        if len(points) > 1:
            d = d.astype(np.float64)
            d[row, place[part]] = np.inf
            second[part] = np.sqrt(d.min(1))
    return place, first, second


def to_own(v: np.ndarray, points: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the point of its place."""
    return ((v - points[place]) ** 2).sum(1)


def gap(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How far both distances may move together before the order can change; at most zero for ties."""
    return second - first - SLACK * (1 + first + np.where(np.isinf(second), 0, second))


def largest_other(moved: np.ndarray) -> np.ndarray:
    """Per entry of the last axis the largest of the others there; 0 without others."""
    if moved.shape[-1] < 2:
        return np.zeros_like(moved)
    order = np.sort(moved, axis=-1)
    top, runner_up = order[..., -1:], order[..., -2:-1]
    return np.where(np.arange(moved.shape[-1]) == moved.argmax(-1)[..., None], runner_up, top)


def _places(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Places by row and part; a plain column is one part."""
    if pa.types.is_list(batch.schema.field(column).type):
        return matrix(batch, column)
    return batch.column(batch.schema.get_field_index(column)).to_numpy().astype(np.int64)[:, None]


def moved_sums(run: DataFrame, place: str, was: str, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """What the counts and sums of all places gain by vectors that changed place; ``shape``: parts, places, components.

    A place of -1 is none. Each task adds up its own vectors, places are added up by Spark, and as many
    numbers as the points have components return.
    """
    parts, places, dim = shape

    def in_task(batches):
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch, "v").reshape(-1, parts, dim)
            now, before = _places(batch, place), _places(batch, was)
            for p in range(parts):
                moved = np.flatnonzero(now[:, p] != before[:, p])
                for at, sign in ((now[moved, p], 1), (before[moved, p], -1)):
                    there = at >= 0
                    np.add.at(sums[p], at[there], sign * v[moved[there], p])
                    np.add.at(counts[p], at[there], sign)
        found = np.flatnonzero(counts.reshape(-1) | sums.reshape(-1, dim).any(1))
        yield pa.RecordBatch.from_pydict({"key": pa.array(found), "n": pa.array(counts.reshape(-1)[found]), "s": lists(sums.reshape(-1, dim)[found], pa.int64())})

    tasks = run.select("v", place, was).mapInArrow(in_task, "key long, n long, s array<long>")
    rows = tasks.select("key", "n", F.posexplode("s").alias("pos", "s")).groupBy("key", "pos").agg(F.sum("n"), F.sum("s")).collect()
    gained, more = np.zeros(shape, object), np.zeros(shape[:2], object)
    for key, pos, n, s in rows:
        gained[(*divmod(key, places), pos)], more[divmod(key, places)] = s, n
    return more, gained
