"""Model choice in one pass: Gram matrices per time fold, ridge regressions from their sums.

One aggregate adds up, for each fold, the products of all features, the label and one. What a model
needs of any folds together is the sum of their matrices, and so is the squared error it makes on
a fold, so every strength is fitted on all but one fold and judged on that one without another scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gram:
    """Sums of products of (features…, label, 1) over the rows of a fold, about given centres."""

    sums: np.ndarray

    @property
    def rows(self) -> float:
        return float(self.sums[-1, -1])

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.sums + other.sums)


def time_fold(date: str, days: int, folds: int) -> Column:
    """The fold of a row: blocks of ``days`` days in turn, so that neighbouring days share a fold."""
    return F.pmod(F.floor(F.unix_date(date) / days), F.lit(folds)).cast("int")


def fold_grams(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> tuple[dict[int, Gram], np.ndarray]:
    """The Gram matrix of each fold, and the centres its values are taken about. Rows lacking a value are left out.

    Two aggregates: the means, to take values about them, then the products; a row per fold comes back.
    """
    names = [*features, label]
    values = df.select(fold.alias("fold"), *(F.col(n).cast("double").alias(f"v{k}") for k, n in enumerate(names))).dropna()
    width = len(names)
    first = values.agg(*(F.avg(f"v{k}") for k in range(width))).first()
    centres = np.array([m if m is not None else 0.0 for m in first])
    about = [F.col(f"v{k}") - float(c) for k, c in enumerate(centres)] + [F.lit(1.0)]
    upper = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    found = values.groupBy("fold").agg(*(F.sum(about[i] * about[j]).alias(f"p{i}_{j}") for i, j in upper)).collect()
    grams = {}
    for row in found:
        sums = np.zeros((width + 1, width + 1))
        for i, j in upper:
            sums[i, j] = sums[j, i] = row[f"p{i}_{j}"]
        grams[row["fold"]] = Gram(sums)
    return grams, centres


def fit_ridge(gram: Gram, strength: float) -> np.ndarray:
    """Weights of the features, each on the scale of its deviation, and the intercept, about the centres.

    The penalty is strength times the rows; the intercept has none. A constant feature has weight 0.
    """
    k = len(gram.sums) - 2
    means = gram.sums[:-1, -1] / gram.rows
    spread = gram.sums[:-1, :-1] - gram.rows * np.outer(means, means)
    scale = np.sqrt(np.diag(spread)[:k] / gram.rows)
    used = scale > 1e-12 * (1 + np.abs(means[:k]))
    weights = np.zeros(k)
    if used.any():
        inner = spread[:k, :k][np.ix_(used, used)] / np.outer(scale[used], scale[used])
        outer = spread[:k, k][used] / scale[used]
        weights[used] = np.linalg.solve(inner + strength * gram.rows * np.eye(used.sum()), outer) / scale[used]
    return np.append(weights, means[k] - means[:k] @ weights)


def squared_error(gram: Gram, weights: np.ndarray) -> float:
    """Sum of squared errors of a model over the rows of a Gram matrix."""
    k = len(weights) - 1
    signed = np.concatenate([-weights[:k], [1.0], -weights[k:]])
    return float(signed @ gram.sums @ signed)


def cross_validated_ridge(df: DataFrame, features: Sequence[str], label: str, fold: Column, strengths: Sequence[float]) -> DataFrame:
    """strength, fold, num_rows, rmse: each fold judged by the model of all others, for each strength."""
    grams, _ = fold_grams(df, features, label, fold)
    rows = []
    for name, own in sorted(grams.items()):
        others = [g for other, g in grams.items() if other != name]
        if not others:
            continue
        rest = sum(others[1:], others[0])
        for strength in strengths:
            error = max(0.0, squared_error(own, fit_ridge(rest, strength)))
            rows.append((float(strength), int(name), int(own.rows), float(np.sqrt(error / own.rows))))
    return df.sparkSession.createDataFrame(rows, "strength double, fold int, num_rows long, rmse double")


def best_strength(judged: DataFrame) -> float | None:
    """The strength with the least error over all folds, the larger of equal ones."""
    error = F.sum(F.col("rmse") * F.col("rmse") * F.col("num_rows"))
    row = judged.groupBy("strength").agg(error.alias("error")).orderBy("error", F.desc("strength")).first()
    return row["strength"] if row else None
