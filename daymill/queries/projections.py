"""Renames, casts, constants, derived columns and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import (
    absolute_difference,
    component_total,
    date_from_parts,
    duration_hours,
    iso_day_of_week,
)
from daymill.operators.conform import (
    SourceSpec,
    add_constants,
    cast_columns,
    conform,
    drop_columns,
    rename_columns,
    union_sources,
)
from daymill.queries.registry import query, rounded, table


@query(
    "SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nation_id, "
    "c_acctbal AS balance, CAST(0 AS DOUBLE) AS fee FROM customer"
)
def conform_rename_drop_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    names = {
        "c_custkey": "party_id",
        "C_NAME": "party_name",
        "c_nationkey": "nation_id",
        "c_acctbal": "balance",
    }
    parties = drop_columns(rename_columns(customer, names), ["c_mktsegment"])
    return add_constants(parties, {"fee": (0, "double")})


@query(
    "SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS DOUBLE) AS user_id, "
    "event_type, value, TRY_CAST(props AS DOUBLE) AS props FROM events"
)
def cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that arrive as text back to declared types; unparsable ones turn null."""
    text = table(spark, sf_dir, "events").withColumns(
        {"value": F.col("value").cast("string"), "user_id": F.col("user_id").cast("string")}
    )
    types = {
        "Event_ID": "int",
        "user_id": "double",
        "event_type": "string",
        "value": "double",
        "props": "double",
        "not_in_this_month": "double",
    }
    return cast_columns(text, types)


PARTY_COLUMNS = ("party_id", "party_name", "nation_id", "balance", "segment", "fee")
CUSTOMERS = SourceSpec(
    name="customers",
    types={"c_acctbal": "double", "c_custkey": "long"},
    rename={
        "c_custkey": "party_id",
        "c_name": "party_name",
        "c_nationkey": "nation_id",
        "c_acctbal": "balance",
        "c_mktsegment": "segment",
    },
    constants={"fee": (0, "double")},
)
SUPPLIERS = SourceSpec(
    name="suppliers",
    types={"s_acctbal": "double", "s_suppkey": "long"},
    rename={
        "s_suppkey": "party_id",
        "s_name": "party_name",
        "s_nationkey": "nation_id",
        "s_acctbal": "balance",
    },
    constants={"segment": ("NONE", "string"), "fee": (1.5, "double")},
)


@query(
    "SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nation_id, "
    "c_acctbal AS balance, c_mktsegment AS segment, CAST(0 AS DOUBLE) AS fee FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'NONE', CAST(1.5 AS DOUBLE) "
    "FROM supplier"
)
def union_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with other names and another order of columns, united by name."""
    customers = conform(table(spark, sf_dir, "customer"), CUSTOMERS)
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_acctbal", "s_nationkey", "s_suppkey", "s_name"
    )
    return union_sources([customers, conform(suppliers, SUPPLIERS)]).select(*PARTY_COLUMNS)


@query(
    "SELECT l_orderkey, l_linenumber, round((floor(epoch(l_shipdate)) - floor(epoch(o_orderdate)))"
    " / 3600, 6) AS hours FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "WHERE (floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 3600 > 0.02"
)
def duration_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    shipped = table(spark, sf_dir, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    timed = shipped.withColumn("hours", duration_hours("o_orderdate", "l_shipdate"))
    kept = timed.filter(F.col("hours") > 0.02).select("l_orderkey", "l_linenumber", "hours")
    return rounded(kept, {"hours": 6})


@query(
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice + l_discount + l_tax, 4) AS total, "
    "round(abs(l_quantity - (l_extendedprice + l_discount + l_tax)), 4) AS difference FROM lineitem"
)
def total_and_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = component_total(["l_extendedprice", "l_discount", "l_tax"])
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(total, 4).alias("total"),
        absolute_difference("l_quantity", total).alias("difference"),
    )


def _order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("string").alias("y"),
        F.month("o_orderdate").cast("string").alias("m"),
        F.dayofmonth("o_orderdate").cast("string").alias("d"),
    )


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_from_short_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _order_parts(spark, sf_dir)
    return parts.select("o_orderkey", date_from_parts("y", "m", "d").alias("day"))


@query(
    "SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 10 AND day(o_orderdate) >= 10 "
    "THEN CAST(o_orderdate AS DATE) END AS day FROM orders"
)
def date_from_parts_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without padding, parts of one digit form no date."""
    parts = _order_parts(spark, sf_dir)
    return parts.select("o_orderkey", date_from_parts("y", "m", "d", pad=False).alias("day"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders"
)
def date_from_long_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of three characters form no date, whatever their first two say."""
    long_ = F.col("o_orderkey") % 2 != 0
    parts = _order_parts(spark, sf_dir).withColumns(
        {c: F.when(long_, F.rpad(c, 3, "3")).otherwise(F.col(c)) for c in ("m", "d")}
    )
    return parts.select("o_orderkey", date_from_parts("y", "m", "d").alias("day"))


@query(
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(isodow(ts) AS INTEGER) AS day_of_week FROM events"
)
def iso_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    return days.withColumn("day_of_week", iso_day_of_week("day"))
