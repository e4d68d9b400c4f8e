"""Row validation: periods, range rules and reconciliation of totals."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions import absolute_difference, component_total
from daymill.period import Period

_COMPARE = {">": operator.gt, ">=": operator.ge, "<=": operator.le}


@dataclass(frozen=True)
class Rule:
    column: str
    compare: str
    bound: float

    def condition(self) -> Column:
        return _COMPARE[self.compare](F.col(self.column), F.lit(self.bound))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows that pass every rule; a null operand fails its rule."""
    return df.filter(reduce(operator.and_, (rule.condition() for rule in rules)))


def filter_dates(df: DataFrame, column: str, period: Period) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(period.start), F.lit(period.end)))


def within_span(start: str, end: str, period: Period, last_day: str = "whole_day") -> Column:
    """Whether a row starts and ends inside the period.

    ``last_day="midnight"`` compares with the bare end date, which is its first
    instant, so the last day is lost; ``"whole_day"`` keeps it. The bounds are date
    literals and reach the Parquet scan with either timestamp type.
    """
    if last_day == "whole_day":
        ends_inside = F.col(end) < F.lit(period.day_after)
    elif last_day == "midnight":
        ends_inside = F.col(end) <= F.lit(period.end)
    else:
        raise ValueError(f"last_day must be 'whole_day' or 'midnight', not {last_day!r}")
    return (F.col(start) >= F.lit(period.start)) & ends_inside


def filter_span(
    df: DataFrame, start: str, end: str, period: Period, last_day: str = "whole_day"
) -> DataFrame:
    """Keep rows that start and end inside the period, see ``within_span``."""
    return df.filter(within_span(start, end, period, last_day))


def reconcile(
    df: DataFrame,
    reported: str,
    components: Sequence[str],
    tolerance: float,
    enforce: bool = True,
    total_name: str = "calc_total_amount",
    difference_name: str = "total_diff",
) -> DataFrame:
    """Recompute a total, add its distance from the reported one, drop rows beyond tolerance.

    ``enforce=False`` only adds the two columns.
    """
    df = df.withColumn(total_name, component_total(components))
    df = df.withColumn(difference_name, absolute_difference(reported, total_name))
    return df.filter(F.col(difference_name) <= tolerance) if enforce else df
