"""Outlier trim: per column keep ``mean ± sqrt(2 ln N) · stddev``, one column after the other.

Each column is judged on the rows that survived the columns before it, so the plain
way costs a scan of the whole table per column. The work here is cut down without
changing the result:

* One aggregate measures every open column. As long as a column removes nothing, the
  same measurements stay true for the next one and settle it too.
* For the columns left, rows are split by a guess. *Core* rows lie well inside the
  likely bounds of all open columns up to the first one they have no value in, where
  they will go; they are measured once, apart by that column. *Edge* rows are the rest,
  a small share however sparse the columns are, and are persisted. The columns are then
  settled one by one from the moments of core rows not gone yet, merged with moments of
  the surviving edge rows, so only the edge is scanned again.
* Every bound found is checked against the guess. One that cuts into the core is still
  right itself, but ends the round: the rows are split anew for the columns after it.
  The guess thus decides the cost only, never the result.

A trim of twelve columns takes about three scans of the table instead of twenty-four
(two more for each cut), and persists the edge instead of the table. The driver sees
at most two more rows of moments than there are columns per action.

NaN and infinity have no place in a mean. By default they count as missing values: in N,
not in mean, deviation and bounds, and their rows go at that column.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import takewhile
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from daymill.operators.profile import fetch_one

LOG = logging.getLogger(__name__)

CORE_SHARE = 0.4
"""Half-width of the core, as a share of the half-width of the expected bounds."""


@dataclass(frozen=True)
class Moments:
    """What one column looks like over a set of rows; nulls count as rows only.

    ``odd`` counts the values that are NaN or infinite and were left out as well.
    """

    rows: int
    values: int
    mean: float | None
    squares: float
    low: float | None
    high: float | None
    odd: int = 0

    @property
    def stddev(self) -> float | None:
        return math.sqrt(self.squares / (self.values - 1)) if self.values > 1 else None

    def __add__(self, other: Moments) -> Moments:
        """Moments of the two disjoint row sets together."""
        rows, odd = self.rows + other.rows, self.odd + other.odd
        if not self.values or not other.values:
            filled = self if self.values else other
            return replace(filled, rows=rows, odd=odd)
        values = self.values + other.values
        shift = other.mean - self.mean
        return Moments(
            rows,
            values,
            self.mean + shift * other.values / values,
            self.squares + other.squares + shift * shift * self.values * other.values / values,
            min(self.low, other.low),
            max(self.high, other.high),
            odd,
        )


NOTHING = Moments(0, 0, None, 0.0, None, None)


@dataclass(frozen=True)
class _Options:
    on_null_stddev: str
    on_non_finite: str

    def value(self, column: str) -> str:
        """SQL of a column's value as a double, null where it does not count."""
        value = f"CAST(`{column}` AS DOUBLE)"
        if self.on_non_finite == "keep":
            return value
        return f"CASE WHEN abs({value}) < double('infinity') THEN {value} END"


@dataclass(frozen=True)
class Bound:
    """Interval a column was trimmed to."""

    column: str
    low: float
    high: float

    def condition(self) -> Column:
        return (F.col(self.column) >= F.lit(self.low)) & (F.col(self.column) <= F.lit(self.high))

    def covers(self, low: float, high: float) -> bool:
        return self.low <= low and high <= self.high

    def keeps_all(self, moments: Moments) -> bool:
        return moments.values == moments.rows and (
            not moments.values or self.covers(moments.low, moments.high)
        )


def trim_outliers(
    df: DataFrame,
    columns: Sequence[str],
    mode: str = "sequential",
    on_null_stddev: str = "skip",
    on_non_finite: str = "drop",
) -> DataFrame:
    """Drop rows outside the bounds of ``outlier_bounds``; rows with a null there go too.

    Finding the bounds runs Spark jobs; the result itself is lazy: ``df`` under one
    filter of literals, which Catalyst can push into the scan.
    """
    return _within(df, outlier_bounds(df, columns, mode, on_null_stddev, on_non_finite))


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str],
    mode: str = "sequential",
    on_null_stddev: str = "skip",
    on_non_finite: str = "drop",
) -> list[Bound]:
    """Bounds per column, in order.

    ``mode="sequential"`` measures each column over the survivors of those before it;
    ``"single_pass"`` measures all over the input rows, in one action.

    A column without a standard deviation (fewer than two values) is left untrimmed,
    or is an error with ``on_null_stddev="error"``. A column holding one single value
    keeps it, though rounding may put its mean just beside it.

    NaN and infinity are taken as missing with ``on_non_finite="drop"``, and their number
    is logged; ``"error"`` raises on them, and ``"keep"`` computes with them as Spark does,
    which leaves no row or only them.
    """
    if mode not in ("sequential", "single_pass"):
        raise ValueError(f"mode must be 'sequential' or 'single_pass', not {mode!r}")
    if on_null_stddev not in ("skip", "error"):
        raise ValueError(f"on_null_stddev must be 'skip' or 'error', not {on_null_stddev!r}")
    if on_non_finite not in ("drop", "error", "keep"):
        raise ValueError(f"on_non_finite must be 'drop', 'error' or 'keep', not {on_non_finite!r}")

    kept = df.select(*dict.fromkeys(columns))
    options = _Options(on_null_stddev, on_non_finite)
    if mode == "single_pass":
        return bounds_of_moments(_measure(kept, columns, options), columns, on_null_stddev, on_non_finite)

    bounds: list[Bound] = []
    todo = list(columns)
    measured: Mapping[str, Moments] = {}
    while todo:
        batch = list(takewhile(lambda column: _is_finite(measured.get(column)), todo))
        if len(batch) > 1:
            settled, found, measured = _settle_split(kept, batch, measured, options)
        else:
            measured = _measure(kept, todo, options)
            settled, found = _settle(todo, measured, options)
        todo, kept = todo[settled:], _within(kept, found)
        bounds += found
    return bounds


def moment_measures(columns: Sequence[str], on_non_finite: str = "drop") -> list[Column]:
    """Aggregates that measure the columns: rows, and values, mean, stddev, low, high and odd by position."""
    return _measures(columns, _Options("skip", on_non_finite))


def bounds_of_moments(
    measured: Mapping[str, Moments], columns: Sequence[str], on_null_stddev: str = "skip", on_non_finite: str = "drop"
) -> list[Bound]:
    """The single-pass bounds that follow from moments measured before."""
    options = _Options(on_null_stddev, on_non_finite)
    found = [_bound(column, measured[column], options) for column in columns]
    return [bound for bound in found if bound]


def within_bounds(df: DataFrame, bounds: Iterable[Bound]) -> DataFrame:
    return _within(df, bounds)


def _settle_split(
    kept: DataFrame, batch: Sequence[str], measured: Mapping[str, Moments], options: _Options
) -> tuple[int, list[Bound], Mapping[str, Moments]]:
    """Settle columns of the batch, at least one, scanning the edge rows only.

    Also returns the latest moments, from which the next split can guess.
    """
    guesses = {column: _guess(column, measured[column]) for column in batch}
    in_core = _in_core(batch, guesses, options)
    core, rim = _measure_parts(kept, batch, in_core, options)
    edge = kept.filter(~in_core).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rest, bounds, done = edge, [], 0
        while True:
            todo = batch[done:]
            merged = {column: core[column] + rim[column] for column in todo}
            settled, found = _settle(todo, merged, options, guesses)
            done, rest = done + settled, _within(rest, found)
            bounds += found
            untrimmed = len(found) < settled  # rows with a gap there stay, which the core does not know
            cut = any(not _covers_guess(bound, guesses) for bound in found)
            if done == len(batch) or cut or untrimmed:
                return done, bounds, merged
            rim = _measure(rest, batch[done:], options)
    finally:
        edge.unpersist()


def _settle(
    columns: Sequence[str],
    measured: Mapping[str, Moments],
    options: _Options,
    guesses: Mapping[str, Bound] | None = None,
) -> tuple[int, list[Bound]]:
    """Bounds in column order, up to the first that makes the measurements stale."""
    bounds: list[Bound] = []
    for done, column in enumerate(columns, start=1):
        bound = _bound(column, measured[column], options)
        if bound is None:
            if guesses:
                return done, bounds
            continue
        bounds.append(bound)
        if not bound.keeps_all(measured[column]) or not _covers_guess(bound, guesses):
            return done, bounds
    return len(columns), bounds


def _covers_guess(bound: Bound, guesses: Mapping[str, Bound] | None) -> bool:
    if not guesses:
        return True
    guess = guesses[bound.column]
    return bound.covers(guess.low, guess.high)


def _bound(column: str, moments: Moments, options: _Options) -> Bound | None:
    if moments.odd:
        if options.on_non_finite == "error":
            raise ValueError(f"column {column!r} has {moments.odd} values that are NaN or infinite")
        LOG.warning("column %r: %d values are NaN or infinite and count as missing", column, moments.odd)
    if moments.stddev is None:
        if options.on_null_stddev == "error":
            raise ValueError(f"column {column!r} has no standard deviation over {moments.rows} rows")
        LOG.warning("column %r has no standard deviation and is not trimmed", column)
        return None
    if moments.low == moments.high:
        return Bound(column, moments.low, moments.high)
    return Bound(column, *_interval(moments, 1.0))


def _guess(column: str, moments: Moments) -> Bound:
    if moments.low == moments.high:
        return Bound(column, moments.low, moments.high)
    return Bound(column, *_interval(moments, CORE_SHARE))


def _interval(moments: Moments, share: float) -> tuple[float, float]:
    reach = math.sqrt(2 * math.log(moments.rows)) * moments.stddev * share
    return moments.mean - reach, moments.mean + reach


def _is_finite(moments: Moments | None) -> bool:
    """Whether a core can be guessed: measured, more than one value, no NaN or infinity."""
    return moments is not None and moments.values > 1 and all(
        map(math.isfinite, (moments.mean, moments.squares, moments.low, moments.high))
    )


def _within(df: DataFrame, bounds: Iterable[Bound]) -> DataFrame:
    conditions = [bound.condition() for bound in bounds]
    return df.filter(reduce(and_, conditions)) if conditions else df


def _in_core(batch: Sequence[str], guesses: Mapping[str, Bound], options: _Options) -> Column:
    """Whether a row is within all guesses before the first column it has no value in."""
    condition = F.lit(True)
    for column in reversed(batch):
        within = F.coalesce(guesses[column].condition(), F.lit(False))
        value = F.expr(options.value(column))
        condition = F.when(value.isNull(), True).when(within, condition).otherwise(False)
    return condition


def _first_gap(batch: Sequence[str], options: _Options) -> Column:
    """Position of the first column without a value, the number of columns if there is none."""
    position = F.lit(len(batch))
    for k, column in reversed(list(enumerate(batch))):
        position = F.when(F.expr(options.value(column)).isNull(), k).otherwise(position)
    return position


def _measure(df: DataFrame, columns: Sequence[str], options: _Options) -> dict[str, Moments]:
    """Moments of all columns from one aggregate, one action."""
    return _moments(fetch_one(df.agg(*_measures(columns, options))), columns)


def _measure_parts(
    df: DataFrame, batch: Sequence[str], in_core: Column, options: _Options
) -> tuple[dict[str, Moments], dict[str, Moments]]:
    """Moments of core and edge rows, in one action.

    A core row counts for the columns before its first gap, and as a row without value
    there; then it is gone.
    """
    gap = F.when(in_core, _first_gap(batch, options))
    parts = {row["gap"]: _moments(row, batch) for row in df.groupBy(gap.alias("gap")).agg(*_measures(batch, options)).collect()}
    rim = parts.pop(None, dict.fromkeys(batch, NOTHING))
    core = {
        column: sum((part[column] for gap_at, part in sorted(parts.items()) if gap_at >= k), NOTHING)
        for k, column in enumerate(batch)
    }
    return core, rim


def _measures(columns: Sequence[str], options: _Options) -> list[Column]:
    measures = ["count(1) AS rows"]
    for position, name in enumerate(dict.fromkeys(columns)):
        value = options.value(name)
        measures += [
            f"count({value}) AS values_{position}",
            f"avg({value}) AS mean_{position}",
            f"stddev_samp({value}) AS stddev_{position}",
            f"min({value}) AS low_{position}",
            f"max({value}) AS high_{position}",
            f"count(`{name}`) - count({value}) AS odd_{position}",
        ]
    return [F.expr(measure) for measure in measures]


def _moments(row: Row, columns: Sequence[str]) -> dict[str, Moments]:
    moments = {}
    for position, name in enumerate(dict.fromkeys(columns)):
        values, stddev = row[f"values_{position}"], row[f"stddev_{position}"]
        moments[name] = Moments(
            row["rows"],
            values,
            row[f"mean_{position}"],
            stddev * stddev * (values - 1) if stddev is not None else 0.0,
            row[f"low_{position}"],
            row[f"high_{position}"],
            row[f"odd_{position}"],
        )
    return moments
