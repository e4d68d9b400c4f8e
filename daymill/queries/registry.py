"""Registry of queries, and helpers for writing them and their oracles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register a query under its function's name."""

    def register(run: Run) -> Run:
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round floating results, whose last digits depend on the order of summation."""
    return df.withColumns({name: F.round(name, d) for name, d in digits.items()})


def rounded_sql(digits: Mapping[str, int]) -> str:
    return ", ".join(f"round({name}, {d}) AS {name}" for name, d in digits.items())


def trim_sql(source: str, columns: Sequence[str], name: str) -> str:
    """CTEs trimming ``source`` column after column into ``name``."""
    steps, before = [], source
    for i, column in enumerate(columns):
        after = name if i == len(columns) - 1 else f"{name}_{i}"
        steps.append(
            f"{name}_stats_{i} AS MATERIALIZED ("
            f"SELECT avg({column}) AS m, stddev_samp({column}) AS s, "
            f"min({column}) AS lo, max({column}) AS hi, "
            f"CASE WHEN count({column}) > 1 THEN sqrt(2 * ln(count(*))) END AS b FROM {before}), "
            f"{after} AS MATERIALIZED (SELECT {before}.* FROM {before}, {name}_stats_{i} "
            f"WHERE s IS NULL OR (lo = hi AND {column} = lo) "
            f"OR (lo < hi AND {column} >= m - b * s AND {column} <= m + b * s))"
        )
        before = after
    return ", ".join(steps)
