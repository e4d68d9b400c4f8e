"""Trim bounds over many periods from moments kept per period.

The moments of a period are a row per column, written once when the period arrives. Merged, they are
those of all periods together, so bounds over years need no scan of old months: a new month costs a
scan of that month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.outliers import NOTHING, Bound, Moments, bounds_of_moments, moment_measures, within_bounds
from daymill.sources.manifest import promote_at_once, read_promoted
from daymill.sources.scans import PERIOD_COLUMN

STATE_TYPES = {
    "column_name": "string",
    "num_rows": "long",
    "num_values": "long",
    "mean": "double",
    "squares": "double",
    "low": "double",
    "high": "double",
    "odd": "long",
}


def moments_by_period(df: DataFrame, columns: Sequence[str], period: str = PERIOD_COLUMN, on_non_finite: str = "drop") -> DataFrame:
    """The moments of each column in each period, one row each, from one aggregate."""
    names = list(dict.fromkeys(columns))
    measured = df.groupBy(period).agg(*moment_measures(names, on_non_finite))

    def row(k: int, name: str):
        values, deviation = F.col(f"values_{k}"), F.coalesce(f"stddev_{k}", F.lit(0.0))
        squares = deviation * deviation * F.greatest(values - 1, F.lit(0))
        found = [F.lit(name), F.col("rows"), values, F.col(f"mean_{k}"), squares, F.col(f"low_{k}"), F.col(f"high_{k}"), F.col(f"odd_{k}")]
        return F.struct(*(c.cast(kind).alias(n) for c, (n, kind) in zip(found, STATE_TYPES.items(), strict=True)))

    return measured.select(F.col(period).alias(PERIOD_COLUMN), F.inline(F.array(*(row(k, name) for k, name in enumerate(names)))))


def keep_moments(df: DataFrame, root: str, source: str, columns: Sequence[str], periods: Sequence[str] = (), **options) -> str:
    """Write the moments of the periods ``df`` has, beside those of others; ``periods`` without rows lose theirs."""
    return promote_at_once(moments_by_period(df, columns, **options), root, source, periods=periods)


def merged_moments(spark: SparkSession, path: str, periods: Sequence[str] | None = None) -> dict[str, Moments]:
    """Moments of all kept periods together, or of some. A row per period and column comes to the driver."""
    merged: dict[str, Moments] = {}
    for r in read_promoted(spark, path, STATE_TYPES, periods).orderBy("column_name", "num_rows", "mean").collect():
        own = Moments(r.num_rows, r.num_values, r["mean"], r.squares, r.low, r.high, r.odd)
        merged[r.column_name] = merged.get(r.column_name, NOTHING) + own
    return merged


def trim_from_state(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    periods: Sequence[str] | None = None,
    on_null_stddev: str = "skip",
    on_non_finite: str = "drop",
) -> DataFrame:
    """``df`` within the bounds of the kept moments: what a single-pass trim of all their rows would keep of it."""
    return within_bounds(df, state_bounds(df.sparkSession, path, columns, periods, on_null_stddev, on_non_finite))


def state_bounds(spark: SparkSession, path: str, columns: Sequence[str], periods=None, on_null_stddev: str = "skip", on_non_finite: str = "drop") -> list[Bound]:
    merged = merged_moments(spark, path, periods)
    missing = [name for name in columns if name not in merged]
    if missing:
        raise ValueError(f"no moments are kept of {', '.join(missing)}")
    return bounds_of_moments(merged, columns, on_null_stddev, on_non_finite)
