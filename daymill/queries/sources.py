"""Scans, sinks and round trips through the text and Parquet layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.conform import SourceSpec, conform
from daymill.period import Period
from daymill.queries.registry import query, table
from daymill.session import scratch_path
from daymill.sources import (
    promote,
    read_delimited,
    read_layer,
    read_parquet,
    scan_period,
    write_table,
)
from daymill.sources.scans import PERIOD_COLUMN


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    events.write.csv(path, header=True)
    types = {
        "event_id": "long",
        "ts": "timestamp_ntz",
        "user_id": "long",
        "event_type": "string",
        "value": "double",
        "props": "string",
    }
    return read_delimited(spark, path, types)


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, "
    "CAST(NULL AS DOUBLE) AS l_returnflag, l_linestatus FROM lineitem"
)
def psv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order than written, one of them text read as a number."""
    path = scratch_path(spark, "psv")
    table(spark, sf_dir, "lineitem").write.csv(path, header=True, sep="|")
    types = {
        "l_orderkey": "long",
        "l_linestatus": "string",
        "l_returnflag": "double",
        "l_linenumber": "int",
        "l_discount": "double",
        "l_quantity": "double",
    }
    return read_delimited(spark, path, types, separator="|")


@query("SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    write_table(table(spark, sf_dir, "orders"), path)
    return read_parquet(spark, path)


ORDER_FEED = SourceSpec(
    name="orders",
    types={"o_orderkey": "long", "o_totalprice": "double", "o_orderstatus": "string"},
    rename={"o_orderkey": "order_id", "o_orderdate": "ordered_at", "o_totalprice": "amount"},
    drop=("o_custkey", "o_orderpriority"),
    constants={"fee": (0, "double")},
)
ORDER_COLUMNS = ("order_id", "ordered_at", "o_orderstatus", "amount", "fee")
SOME_ORDERS = Period.of("1996-11-15", "1999-02-10")


def landing_orders(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """Monthly order files, as a feed would deliver them, and their months."""
    orders = table(spark, sf_dir, "orders")
    monthly = orders.withColumn(PERIOD_COLUMN, F.date_format("o_orderdate", "yyyy-MM"))
    path = promote(monthly, scratch_path(spark, "landing"), "orders", rebalance=True)
    months = read_parquet(spark, path).select(PERIOD_COLUMN).distinct().collect()
    return f"{path}/{PERIOD_COLUMN}={{period}}", sorted(row[PERIOD_COLUMN] for row in months)


@query(
    "SELECT o_orderkey AS order_id, o_orderdate AS ordered_at, o_orderstatus, o_totalprice AS amount, "
    "CAST(0 AS DOUBLE) AS fee, strftime(o_orderdate, '%Y-%m') AS month FROM orders"
)
def period_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every monthly file, conformed, each row with its file's month."""
    template, months = landing_orders(spark, sf_dir)
    return scan_period(
        spark, template, months, lambda df: conform(df, ORDER_FEED, ORDER_COLUMNS), stamp="month"
    )


@query(
    "SELECT o_orderkey AS order_id, o_orderdate AS ordered_at, o_orderstatus, "
    "o_totalprice AS amount, CAST(0 AS DOUBLE) AS fee FROM orders "
    "WHERE o_orderdate >= '1996-11-01' AND o_orderdate < '1999-03-01'"
)
def promote_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders into the raw layer, the months of one period read back."""
    orders = table(spark, sf_dir, "orders")
    raw = conform(orders, ORDER_FEED, ORDER_COLUMNS)
    stamped = raw.withColumn(PERIOD_COLUMN, F.date_format("ordered_at", "yyyy-MM"))
    path = promote(stamped, scratch_path(spark, "raw"), "orders", rebalance=True)
    return read_layer(spark, path, dict(raw.dtypes), SOME_ORDERS.months())


@query(
    "SELECT o_orderkey AS order_id, o_orderdate AS ordered_at, o_orderstatus, "
    "o_totalprice AS amount, CAST(0 AS DOUBLE) AS fee FROM orders "
    "WHERE o_orderdate < '1996-11-01' OR o_orderdate >= '1999-03-01' "
    "OR (o_totalprice > 1000 AND (o_orderdate < '1997-01-01' OR o_orderdate >= '1997-02-01'))"
)
def promote_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then corrected files of some months, one of which has become empty."""
    raw = conform(table(spark, sf_dir, "orders"), ORDER_FEED, ORDER_COLUMNS)
    stamped = raw.withColumn(PERIOD_COLUMN, F.date_format("ordered_at", "yyyy-MM"))
    root, months = scratch_path(spark, "raw"), SOME_ORDERS.months()
    promote(stamped, root, "orders", rebalance=True)
    named = F.col(PERIOD_COLUMN).isin(months)
    corrected = stamped.filter(named & (F.col("amount") > 1000) & (F.col(PERIOD_COLUMN) != "1997-01"))
    path = promote(corrected, root, "orders", rebalance=True, periods=months)
    return read_layer(spark, path, dict(raw.dtypes))
