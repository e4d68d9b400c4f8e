"""Periods, range rules and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.rules import Rule, apply_rules, filter_dates, filter_span, reconcile
from daymill.period import Period
from daymill.queries.registry import query, rounded, table

MID_JANUARY = Period.of("2024-01-08", "2024-01-21")


@query("SELECT * FROM events WHERE ts >= '2024-01-08' AND ts < '2024-01-22'")
def period_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_span(table(spark, sf_dir, "events"), "ts", "ts", MID_JANUARY)


@query("SELECT * FROM events WHERE ts >= '2024-01-08' AND ts <= '2024-01-21'")
def period_ts_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_span(table(spark, sf_dir, "events"), "ts", "ts", MID_JANUARY, "midnight")


@query(
    "SELECT event_id, CAST(ts AS DATE) AS date, value FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN '2024-01-08' AND '2024-01-21'"
)
def period_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("date"), "value")
    return filter_dates(days, "date", MID_JANUARY)


LINE_RULES = (
    Rule("l_quantity", ">", 1),
    Rule("l_quantity", "<=", 45),
    Rule("l_extendedprice", ">=", 2500.0),
    Rule("l_discount", ">=", 0.02),
    Rule("l_discount", "<=", 0.09),
    Rule("l_tax", ">", 0),
    Rule("l_linenumber", ">=", 1),
    Rule("l_linenumber", "<=", 6),
)


@query(
    "SELECT * FROM lineitem WHERE l_quantity > 1 AND l_quantity <= 45 AND l_extendedprice >= 2500 "
    "AND l_discount >= CAST(0.02 AS DOUBLE) AND l_discount <= CAST(0.09 AS DOUBLE) AND l_tax > 0 "
    "AND l_linenumber >= 1 AND l_linenumber <= 6"
)
def range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "lineitem"), LINE_RULES)


RECONCILED = (
    "SELECT l_orderkey, l_linenumber, round(calc, 4) AS calc_total_amount, diff AS total_diff FROM "
    "(SELECT *, round(abs(o_totalprice - calc), 4) AS diff FROM (SELECT l_orderkey, l_linenumber, "
    "o_totalprice, l_extendedprice + l_discount + l_tax AS calc "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"
)


def _reconciled(spark: SparkSession, sf_dir: str, enforce: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    components = ["l_extendedprice", "l_discount", "l_tax"]
    checked = reconcile(lines, "o_totalprice", components, tolerance=10_000, enforce=enforce)
    columns = ["l_orderkey", "l_linenumber", "calc_total_amount", "total_diff"]
    return rounded(checked.select(*columns), {"calc_total_amount": 4})


@query(RECONCILED)
def reconcile_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir, enforce=False)


@query(RECONCILED + " WHERE diff <= 10000")
def reconcile_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir, enforce=True)
