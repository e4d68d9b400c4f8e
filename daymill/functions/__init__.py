"""Column expressions shared by the operators. All run inside Spark's codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def duration_hours(start: ColumnLike, end: ColumnLike) -> Column:
    """Hours from start to end, counted in whole seconds; negative if end is earlier."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))) / 3600


def component_total(components: Sequence[ColumnLike]) -> Column:
    """Sum of the components; null as soon as one of them is null."""
    return reduce(add, map(as_column, components))


def absolute_difference(left: ColumnLike, right: ColumnLike, digits: int = 4) -> Column:
    return F.round(F.abs(as_column(left) - as_column(right)), digits)


def midpoint(left: ColumnLike, right: ColumnLike) -> Column:
    return (as_column(left) + as_column(right)) / 2


def date_from_parts(
    year: ColumnLike, month: ColumnLike, day: ColumnLike, pad: bool = True
) -> Column:
    """Date from text or integer parts, null where they form no date.

    With ``pad`` months and days of one digit are accepted; without it they must
    already have two. Longer parts form no date.
    """
    parts = [as_column(part).cast("string") for part in (year, month, day)]
    if pad:
        parts[1:] = [
            F.when(F.length(part) == 1, F.concat(F.lit("0"), part)).otherwise(part)
            for part in parts[1:]
        ]
    return F.try_to_date(F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]), "yyyy-MM-dd")


def iso_day_of_week(day: ColumnLike) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(as_column(day)) + 1


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, null over zero whatever the session's ANSI setting."""
    return F.try_divide(as_column(numerator), as_column(denominator))
