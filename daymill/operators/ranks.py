"""Exact ranks of columns with ties, and rank correlations, without a window over a whole table.

A value's rank is the number of smaller values plus the middle of its own ties. So values are counted
first, which makes one row of a value that a third of all rows have. The distinct values are dealt by
ranges; the counts before a value are those of the ranges before, from a small table of ranges, and
those before it within its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill.session import scratch_path


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written and read back: ranges and their offsets must come from the same run."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, n, rank: each distinct value of the columns, its rows, and its rank from 1 on, ties at their middle.

    Values are doubles; nulls and NaN have no rank.
    """
    named = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns))
    counted = df.select(F.inline(named)).filter("value IS NOT NULL AND NOT isnan(value)").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return _ranked(counted, "column_name", "value").select("column_name", "value", "n", "rank")


def rank_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """column_name, rank_correlation: Spearman's, of each column with the target, over rows that have both; null if one is constant.

    A pair's ranks are taken over the rows that have both values. Ranks of the columns' values are joined to the rows,
    which are then summed up once per value of the target, for all columns together; pairs of values are never counted.
    """
    names = list(dict.fromkeys(columns))
    rows = df.select(_number(target).alias("y"), *(_number(c).alias(f"x{k}") for k, c in enumerate(names))).filter("y IS NOT NULL")
    values = F.array(*(F.struct(F.lit(k).alias("pair"), F.col(f"x{k}").alias("x")) for k in range(len(names))))
    counted = rows.select(F.inline(values)).filter("x IS NOT NULL").groupBy("pair", "x").agg(F.count("*").alias("n"))
    # ranks about their middle, (rows + 1) / 2, so that large sums do not cancel
    own = _stored(_about_middle(_ranked(counted, "pair", "x")).select("pair", "x", "n", "off"), "rank-values")
    for k in range(len(names)):
        rows = rows.join(own.filter(F.col("pair") == k).select(F.col("x").alias(f"x{k}"), F.col("off").alias(f"off{k}")), f"x{k}", "left")
    sums = [m for k in range(len(names)) for m in (F.count(f"off{k}").alias(f"n{k}"), F.sum(f"off{k}").alias(f"s{k}"))]
    found = F.array(*(F.struct(F.lit(k).alias("pair"), F.col(f"n{k}").alias("n"), F.col(f"s{k}").alias("s")) for k in range(len(names))))
    by_target = rows.groupBy("y").agg(*sums).select("y", F.inline(found)).filter("n > 0")
    ys = _about_middle(_ranked(by_target, "pair", "y"))
    n, off = F.col("n").cast("double"), F.col("off")
    own_squares = own.groupBy("pair").agg(F.sum(n * off * off).alias("xx"))
    both = ys.groupBy("pair").agg(F.sum(F.col("s") * off).alias("xy"), F.sum(n * off * off).alias("yy")).join(F.broadcast(own_squares), "pair")  # a row per column
    correlation = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
    return both.select(F.get(F.array(*map(F.lit, names)), F.col("pair")).alias("column_name"), correlation.alias("rank_correlation"))


def _number(name: str) -> Column:
    """A column's value as a double; NaN is none."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _about_middle(ranked: DataFrame) -> DataFrame:
    """With ``off``, each value's rank less the middle one of its pair."""
    middle = ranked.groupBy("pair").agg(((F.sum("n") + 1) / 2).alias("middle"))
    return ranked.join(F.broadcast(middle), "pair").withColumn("off", F.col("rank") - F.col("middle"))  # a row per column


def _ranked(counted: DataFrame, group: str, value: str) -> DataFrame:
    """Ranks within each group of its distinct values, which have ``n`` rows each."""
    ranges = _stored(counted.repartitionByRange(group, value).withColumn("slice", F.spark_partition_id()), "rank-ranges")
    sizes = ranges.groupBy(group, "slice").agg(F.sum("n").alias("size"))
    offsets = sizes.select(group, "slice", (F.sum("size").over(Window.partitionBy(group).orderBy("slice")) - F.col("size")).alias("before"))
    in_slice = Window.partitionBy(group, "slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranges.withColumn("up_to", F.sum("n").over(in_slice)).join(offsets, [group, "slice"])
    return joined.withColumn("rank", F.col("before") + F.col("up_to") - (F.col("n") - 1) / 2)
