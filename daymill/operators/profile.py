"""Shapes, descriptive statistics and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)


def shape_frame(df: DataFrame) -> DataFrame:
    """The shape as a frame of one row."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).withColumn(
        "num_columns", F.lit(len(df.columns)).cast("long")
    )


def global_stats(df: DataFrame, column: str) -> DataFrame:
    """Mean and sample standard deviation of a column, one row."""
    return df.agg(F.mean(column).alias("mean"), F.stddev_samp(column).alias("stddev"))


def fetch_one(df: DataFrame) -> Row:
    """The single row of an aggregate, on the driver."""
    return df.first()


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, stddev, min and max of numeric columns, one row per column.

    All columns share one aggregate over one scan; only its single row is turned
    into the long form.
    """

    def summary(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(value).alias("num_values"),
            F.mean(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    return df.agg(F.array(*map(summary, columns)).alias("summaries")).select(F.inline("summaries"))


def show_profile(df: DataFrame, columns: Sequence[str]) -> None:
    """Print Spark's own description of the columns, one value per line."""
    df.select(*columns).describe().show(vertical=True)


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with the target, from one aggregate."""
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.corr(name, target).alias("correlation"))
        for name in columns
    ]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))
