"""Counts along the way, layers that change at once, quartiles, quarantined text and kept trim state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymill.operators.conform import conform
from daymill.operators.quantiles import QUARTILES, five_numbers, merged_quantiles, rank_errors, sketches
from daymill.operators.steps import apply_steps, rule_steps, step_report
from daymill.operators.trim_state import keep_moments, trim_from_state
from daymill.queries.aggregates import PROFILED
from daymill.queries.filters import LINE_RULES
from daymill.queries.registry import query, rounded, table
from daymill.queries.sources import ORDER_COLUMNS, ORDER_FEED, SOME_ORDERS
from daymill.session import scratch_path
from daymill.sources import write_table
from daymill.sources.manifest import promote_at_once, read_promoted
from daymill.sources.quarantine import promote_checked, read_accepted, read_checked, read_quarantined
from daymill.sources.scans import PERIOD_COLUMN

_PASSES = [f"coalesce({r.column} {r.compare} CAST({r.bound} AS DOUBLE), false)" for r in LINE_RULES]


def _left(k: int) -> str:
    return " AND ".join(_PASSES[:k]) or "true"


@query(
    "SELECT 0::INTEGER AS position, 'input' AS step, 0::BIGINT AS num_failed, 0::BIGINT AS num_failed_first, "
    "count(*) AS num_left FROM lineitem UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {k + 1}, '{r.column} {r.compare} {r.bound:g}', count(*) FILTER (NOT {_PASSES[k]}), "
        f"count(*) FILTER ({_left(k)} AND NOT {_PASSES[k]}), count(*) FILTER ({_left(k + 1)}) FROM lineitem"
        for k, r in enumerate(LINE_RULES)
    )
)
def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows failing each rule, counted by the write of those that pass all."""
    steps, counts = rule_steps(LINE_RULES), Observation()
    write_table(apply_steps(table(spark, sf_dir, "lineitem"), steps, counts), scratch_path(spark, "valid-lines"))
    return step_report(spark, steps, counts)


@query(
    "SELECT o_orderkey AS order_id, o_orderdate AS ordered_at, o_orderstatus, "
    "o_totalprice AS amount, CAST(0 AS DOUBLE) AS fee FROM orders "
    "WHERE o_orderdate < '1996-11-01' OR o_orderdate >= '1999-03-01' "
    "OR (o_totalprice > 1000 AND (o_orderdate < '1997-01-01' OR o_orderdate >= '1997-02-01'))"
)
def promote_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then corrected months, one of them empty; rows of a promotion that never ended do not show."""
    raw = conform(table(spark, sf_dir, "orders"), ORDER_FEED, ORDER_COLUMNS)
    stamped = raw.withColumn(PERIOD_COLUMN, F.date_format("ordered_at", "yyyy-MM"))
    root, months = scratch_path(spark, "raw"), SOME_ORDERS.months()
    path = promote_at_once(stamped, root, "orders", rebalance=True)
    stamped.write.partitionBy(PERIOD_COLUMN).parquet(f"{path}/batch=unfinished")
    named = F.col(PERIOD_COLUMN).isin(months)
    corrected = stamped.filter(named & (F.col("amount") > 1000) & (F.col(PERIOD_COLUMN) != "1997-01"))
    promote_at_once(corrected, root, "orders", rebalance=True, periods=months)
    return read_promoted(spark, path, dict(raw.dtypes))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
        for c in PROFILED
    )
)
def column_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = five_numbers(table(spark, sf_dir, "lineitem"), PROFILED)
    return rounded(found, {"q25": 6, "median": 6, "q75": 6})


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS num_values, CAST({p} AS DOUBLE) AS probability, true AS within_bound FROM lineitem"
        for c in PROFILED
        for p in QUARTILES
    )
)
def sketched_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles from the sketches of all months, each within 2 % of the rows of its exact rank."""
    lines = table(spark, sf_dir, "lineitem").withColumn(PERIOD_COLUMN, F.date_format("l_shipdate", "yyyy-MM"))
    path = promote_at_once(sketches(lines, PROFILED, PERIOD_COLUMN), scratch_path(spark, "sketches"), "lines")
    found = merged_quantiles(read_promoted(spark, path, {"column_name": "string", "sketch": "binary"})).collect()
    values: dict[str, dict[float, float]] = {}
    for r in found:
        values.setdefault(r.column_name, {})[r.probability] = r.value
    errors = rank_errors(lines, values)
    rows = [(r.column_name, r.num_values, r.probability, errors[r.column_name, r.probability] <= 0.02) for r in found]
    return spark.createDataFrame(rows, "column_name string, num_values long, probability double, within_bound boolean")


_ODD_TEXT = {"value": ("event_id % 97 = 0", "'T'"), "user_id": ("event_id % 101 = 0", "concat(user_id, 'x')"), "ts": ("event_id % 89 = 0", "'yesterday'")}
_FEED_TYPES = {"event_id": "long", "ts": "timestamp_ntz", "user_id": "int", "value": "double"}


@query(
    "WITH judged AS (SELECT event_id, CASE WHEN event_id % 89 = 0 THEN 'ts is no timestamp_ntz' WHEN event_id % 101 = 0 THEN 'user_id is no int' "
    "WHEN event_id % 97 = 0 THEN 'value is no double' END AS reason, value FROM events) "
    "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS num_rows, round(coalesce(sum(value) FILTER (reason IS NULL), 0), 4) AS total FROM judged GROUP BY 1"
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text feed with odd fields: every line is kept or quarantined with its reason, by one write."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    text = events.select(
        "event_id", *(F.expr(f"IF({odd}, {other}, CAST({name} AS STRING)) AS {name}") for name, (odd, other) in sorted(_ODD_TEXT.items()))
    )
    feed = scratch_path(spark, "feed")
    text.write.csv(feed, header=True)
    checked = read_checked(spark, feed, _FEED_TYPES).withColumn(PERIOD_COLUMN, F.lit("all"))
    path = promote_checked(checked, scratch_path(spark, "raw"), "events")
    kept = read_accepted(spark, path, _FEED_TYPES).select(F.lit("accepted").alias("reason"), "value")
    odd = read_quarantined(spark, path).select("reason", F.lit(0.0).alias("value"))
    return rounded(kept.union(odd).groupBy("reason").agg(F.count("*").alias("num_rows"), F.sum("value").alias("total")), {"total": 4})


@query(
    "WITH squared AS (SELECT event_id, value, value * value AS value_squared FROM events), "
    "stats AS (SELECT avg(value) AS m1, stddev_samp(value) AS s1, "
    "avg(value_squared) AS m2, stddev_samp(value_squared) AS s2, sqrt(2 * ln(count(*))) AS b "
    "FROM squared) SELECT event_id, value FROM squared, stats "
    "WHERE value >= m1 - b * s1 AND value <= m1 + b * s1 "
    "AND value_squared >= m2 - b * s2 AND value_squared <= m2 + b * s2"
)
def trim_from_kept_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds over all days from moments kept day by day, the second half of the days added later."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", (F.col("value") * F.col("value")).alias("value_squared"), F.date_format("ts", "yyyy-MM-dd").alias(PERIOD_COLUMN)
    )
    root, columns = scratch_path(spark, "moments"), ["value", "value_squared"]
    early = F.col(PERIOD_COLUMN) < "2024-01-15"
    keep_moments(events.filter(early), root, "events", columns)
    path = keep_moments(events.filter(~early), root, "events", columns)
    return trim_from_state(events, path, columns).select("event_id", "value")
