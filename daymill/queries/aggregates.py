"""Statistics, profiles, daily aggregates and the join of aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.daily import add_day_of_week, daily_aggregate, join_back, sort_by_date
from daymill.operators.profile import correlations, global_stats, profile, shape_frame
from daymill.queries.registry import query, rounded, table


def _dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))


DATED = "(SELECT *, CAST(ts AS DATE) AS date FROM events)"


@query("SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev FROM events")
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = global_stats(table(spark, sf_dir, "events"), "value")
    return rounded(stats, {"mean": 6, "stddev": 6})


PROFILED = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS num_values, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
        for c in PROFILED
    )
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = profile(table(spark, sf_dir, "lineitem"), PROFILED)
    return rounded(profiled, {"mean": 6, "stddev": 6})


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 6) AS correlation FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
)
def column_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    found = correlations(lines, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return rounded(found, {"correlation": 6})


@query("SELECT count(*) AS num_rows, CAST(11 AS BIGINT) AS num_columns FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_frame(table(spark, sf_dir, "lineitem"))


@query(
    "SELECT event_type, date, count(*) AS num_events, round(avg(value), 8) AS avg_value, "
    "round(avg(user_id), 8) AS avg_user, round(avg(value) / avg(user_id), 8) AS value_per_user, "
    f"CAST(isodow(date) AS INTEGER) AS day_of_week FROM {DATED} GROUP BY event_type, date"
)
def daily_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_aggregate(
        _dated_events(spark, sf_dir),
        ["event_type", "date"],
        count="num_events",
        means={"avg_value": "value", "avg_user": "user_id"},
        ratios={"value_per_user": ("avg_value", "avg_user")},
    )
    digits = {"avg_value": 8, "avg_user": 8, "value_per_user": 8}
    return rounded(add_day_of_week(daily), digits)


@query(
    "SELECT event_type, date, round(sum(value), 4) AS total_value, "
    "round(sum((value + user_id) / 2), 4) AS blended_value "
    f"FROM {DATED} GROUP BY event_type, date ORDER BY date, event_type"
)
def daily_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_aggregate(
        _dated_events(spark, sf_dir),
        ["event_type", "date"],
        sums={"total_value": "value", "blended_value": (F.col("value") + F.col("user_id")) / 2},
    )
    digits = {"total_value": 4, "blended_value": 4}
    return sort_by_date(rounded(daily, digits), "date", "event_type")


@query(
    "SELECT date, round(avg(value), 8) AS mean_value, round(avg(user_id), 8) AS mean_user "
    f"FROM {DATED} GROUP BY date"
)
def daily_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = {"mean_value": "value", "mean_user": "user_id"}
    daily = daily_aggregate(_dated_events(spark, sf_dir), ["date"], means=means)
    return rounded(daily, {"mean_value": 8, "mean_user": 8})


@query(
    "WITH shipped AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS num_lines FROM lineitem "
    "GROUP BY 1), ordered AS (SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) "
    "AS revenue FROM orders GROUP BY 1) SELECT shipped.date, num_lines, revenue "
    "FROM shipped LEFT JOIN ordered ON shipped.date = ordered.date"
)
def join_daily_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily aggregates of two tables, one day per row; days without orders keep a null."""
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    shipped = daily_aggregate(lines, ["date"], count="num_lines")
    ordered = daily_aggregate(orders, ["date"], sums={"revenue": "o_totalprice"})
    return join_back(shipped, rounded(ordered, {"revenue": 2}), ["date"])


@query(
    "WITH keyed AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, "
    "CAST(ts AS DATE) AS date, value FROM events), a AS (SELECT kind, date, count(*) AS num_events "
    "FROM keyed GROUP BY kind, date), b AS (SELECT kind, date, round(sum(value), 4) AS total_value "
    "FROM keyed GROUP BY kind, date) SELECT a.kind, a.date, num_events, total_value "
    "FROM a LEFT JOIN b ON a.kind = b.kind AND a.date = b.date"
)
def join_back_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key finds no partner: its count stays, its total is null."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = _dated_events(spark, sf_dir).withColumn("kind", kind)
    counts = daily_aggregate(events, ["kind", "date"], count="num_events")
    totals = daily_aggregate(events, ["kind", "date"], sums={"total_value": "value"})
    return join_back(counts, rounded(totals, {"total_value": 4}), ["kind", "date"])
