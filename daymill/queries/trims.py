"""Outlier trims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.outliers import trim_outliers
from daymill.queries.registry import query, table, trim_sql


def _squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return events.withColumn("value_squared", F.col("value") * F.col("value"))


SQUARED = "squared AS (SELECT event_id, value, value * value AS value_squared FROM events)"


@query(
    f"WITH {SQUARED}, {trim_sql('squared', ['value', 'value_squared'], 'kept')} "
    "SELECT event_id, value FROM kept"
)
def trim_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = trim_outliers(_squared(spark, sf_dir), ["value", "value_squared"])
    return kept.select("event_id", "value")


@query(
    f"WITH {SQUARED}, {trim_sql('squared', ['value_squared', 'value'], 'kept')} "
    "SELECT event_id, value FROM kept"
)
def trim_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of the columns matters."""
    kept = trim_outliers(_squared(spark, sf_dir), ["value_squared", "value"])
    return kept.select("event_id", "value")


@query(
    f"WITH {SQUARED}, stats AS (SELECT avg(value) AS m1, stddev_samp(value) AS s1, "
    "avg(value_squared) AS m2, stddev_samp(value_squared) AS s2, sqrt(2 * ln(count(*))) AS b "
    "FROM squared) SELECT event_id, value FROM squared, stats "
    "WHERE value >= m1 - b * s1 AND value <= m1 + b * s1 "
    "AND value_squared >= m2 - b * s2 AND value_squared <= m2 + b * s2"
)
def trim_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["value", "value_squared"]
    kept = trim_outliers(_squared(spark, sf_dir), columns, mode="single_pass")
    return kept.select("event_id", "value")


@query(
    "WITH parsed AS (SELECT event_id, TRY_CAST(props AS DOUBLE) AS reading, value FROM events), "
    f"{trim_sql('parsed', ['reading', 'value'], 'kept')} SELECT event_id, value FROM kept"
)
def trim_null_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column without a single number has no deviation and trims nothing."""
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.col("props").try_cast("double").alias("reading"), "value")
    return trim_outliers(parsed, ["reading", "value"]).select("event_id", "value")


LINE_MEASURES = {
    "unit_price": "l_extendedprice / l_quantity",
    "discount_money": "l_extendedprice / l_quantity * l_discount",
    "tax_money": "l_extendedprice / l_quantity * l_tax",
    "l_quantity": "l_quantity",
    "money_per_day": "l_extendedprice / l_quantity / day(l_shipdate)",
    "inverse_price": "1000 / l_extendedprice",
    "l_extendedprice": "l_extendedprice",
}
LINE_MEASURES_SQL = ", ".join(f"{sql} AS {name}" for name, sql in LINE_MEASURES.items())


@query(
    f"WITH measures AS (SELECT l_orderkey, l_linenumber, l_partkey, {LINE_MEASURES_SQL} FROM lineitem), "
    f"{trim_sql('measures', list(LINE_MEASURES), 'kept')} "
    "SELECT l_orderkey, l_linenumber, l_partkey FROM kept"
)
def trim_many_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-tailed measures of lineitem, most of which lose rows."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", *(f"{s} AS {n}" for n, s in LINE_MEASURES.items())
    )
    kept = trim_outliers(lines, list(LINE_MEASURES))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


SPARSE_MEASURES = {
    "unit_price": "l_extendedprice / l_quantity",
    "discount_money": "l_extendedprice / l_quantity * l_discount",
    "rare": "CASE WHEN l_partkey % 10 = 0 THEN l_extendedprice / l_quantity * l_tax END",
    "rarer": "CASE WHEN l_suppkey % 3 = 0 THEN 1000 / l_extendedprice END",
    "l_quantity": "l_quantity",
}
SPARSE_SQL = ", ".join(f"{sql} AS {name}" for name, sql in SPARSE_MEASURES.items())


@query(
    f"WITH measures AS (SELECT l_orderkey, l_linenumber, l_partkey, {SPARSE_SQL} FROM lineitem), "
    f"{trim_sql('measures', list(SPARSE_MEASURES), 'kept')} "
    "SELECT l_orderkey, l_linenumber, l_partkey FROM kept"
)
def trim_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without a value in most rows, behind others that lose rows."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", *(f"{s} AS {n}" for n, s in SPARSE_MEASURES.items())
    )
    kept = trim_outliers(lines, list(SPARSE_MEASURES))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "WITH odd AS (SELECT event_id, CASE WHEN event_id % 100 > 2 THEN value END AS reading, "
    f"value * value AS value_squared FROM events), {trim_sql('odd', ['value_squared', 'reading'], 'kept')} "
    "SELECT event_id FROM kept"
)
def trim_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinity count as missing values."""
    odd = "get(array(double('NaN'), double('Infinity'), double('-Infinity')), int(event_id % 100))"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"IF(event_id % 100 > 2, value, {odd}) AS reading", "value * value AS value_squared"
    )
    return trim_outliers(events, ["value_squared", "reading"]).select("event_id")
