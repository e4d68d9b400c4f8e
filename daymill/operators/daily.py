"""Daily aggregates per group or per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions import ColumnLike, as_column, iso_day_of_week, ratio


def daily_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    count: str | None = None,
    means: Mapping[str, ColumnLike] | None = None,
    sums: Mapping[str, ColumnLike] | None = None,
    ratios: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Row count, means and sums per key, then ratios of those results.

    Everything comes from one ``groupBy``, so a key pair is shuffled once and only
    after partial aggregation: a key with a third of all rows sends one row per task.
    Ratios divide two aggregates (a ratio of means, not a mean of ratios).
    """
    measures = [F.count(F.lit(1)).alias(count)] if count else []
    measures += [F.mean(as_column(c)).alias(name) for name, c in (means or {}).items()]
    measures += [F.sum(as_column(c)).alias(name) for name, c in (sums or {}).items()]
    daily = df.groupBy(*keys).agg(*measures)
    for name, (numerator, denominator) in (ratios or {}).items():
        daily = daily.withColumn(name, ratio(numerator, denominator))
    return daily


def join_back(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two aggregates on shared keys.

    Null keys match nothing, so such a left row keeps nulls for the right columns.
    Two aggregates of the *same* table belong in one ``daily_aggregate`` instead.
    """
    return left.join(right, on=list(keys), how="left")


def add_day_of_week(df: DataFrame, date: str = "date", name: str = "day_of_week") -> DataFrame:
    return df.withColumn(name, iso_day_of_week(date))


def sort_by_date(df: DataFrame, date: str = "date", *ties: str) -> DataFrame:
    """Ascending by date, for use right before a sink.

    ``ties`` order the rows of a day and let the range shuffle split a crowded day.
    """
    return df.orderBy(date, *ties)
