"""Tables laid out for two keys, joins without a shuffle, rank correlations and model choice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymill.operators.ranks import rank_correlations as ranked
from daymill.plans.ridge import cross_validated_ridge as ridge
from daymill.plans.ridge import time_fold
from daymill.queries.modelling import FEATURES_SQL, daily_tables
from daymill.queries.registry import query, rounded, table
from daymill.session import scratch_path
from daymill.sources.sorted_sink import join_bucketed, write_bucketed, write_interleaved

RANKED = ("l_quantity", "l_discount", "l_tax")


def _middle_rank(name: str) -> str:
    return f"rank() OVER (ORDER BY {name}) + (count(*) OVER (PARTITION BY {name}) - 1) / 2.0"


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(corr(x, y), 8) AS rank_correlation FROM "
        f"(SELECT {_middle_rank(c)} AS x, {_middle_rank('l_extendedprice')} AS y FROM lineitem WHERE {c} IS NOT NULL AND l_extendedprice IS NOT NULL)"
        for c in RANKED
    )
)
def rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranked(table(spark, sf_dir, "lineitem"), "l_extendedprice", RANKED), {"rank_correlation": 8})


STRENGTHS = (0.0, 0.05, 1.0)

RIDGE_SQL = f"""
WITH rows_ AS (SELECT l_quantity::DOUBLE AS a, l_discount::DOUBLE AS b, l_extendedprice::DOUBLE AS y,
  (floor((CAST(l_shipdate AS DATE) - DATE '1970-01-01') / 30.0) % 4)::INTEGER AS fold FROM lineitem),
strengths AS (SELECT unnest({list(STRENGTHS)})::DOUBLE AS strength), folds AS (SELECT DISTINCT fold FROM rows_),
m AS (SELECT folds.fold, avg(a) AS am, avg(b) AS bm, avg(y) AS ym, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
  covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) AS r, covar_pop(a, y) / stddev_pop(a) AS ca, covar_pop(b, y) / stddev_pop(b) AS cb
  FROM folds JOIN rows_ ON rows_.fold <> folds.fold GROUP BY folds.fold),
w AS (SELECT m.*, strength, ((1 + strength) * ca - r * cb) / ((1 + strength) ** 2 - r * r) / sa AS wa,
  ((1 + strength) * cb - r * ca) / ((1 + strength) ** 2 - r * r) / sb AS wb FROM m, strengths)
SELECT strength, w.fold, count(*) AS num_rows,
  round(sqrt(avg((y - ym - wa * (a - am) - wb * (b - bm)) ** 2)), 4) AS rmse
FROM w JOIN rows_ ON rows_.fold = w.fold GROUP BY strength, w.fold"""


@query(RIDGE_SQL)
def cross_validated_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three strengths, each judged on every fourth month by the model of the others."""
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    judged = ridge(lines, ["l_quantity", "l_discount"], "l_extendedprice", time_fold("date", 30, 4), STRENGTHS)
    return rounded(judged, {"rmse": 4})


@query(
    "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, true AS in_order FROM lineitem"
)
def interleaved_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines laid out by supplier and day and read back; each one not before the line above it in its file."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber")
    path = scratch_path(spark, "interleaved")
    write_interleaved(lines, path, "l_suppkey", "date", files=16)
    placed = spark.read.parquet(path).withColumns({"file": F.input_file_name(), "at": F.monotonically_increasing_id()})
    here = F.struct("l_suppkey", "date")
    before = F.lag(here).over(Window.partitionBy("file").orderBy("at"))
    return placed.withColumn("in_order", F.coalesce(before <= here, F.lit(True))).drop("file", "at")


@query(
    f"{FEATURES_SQL} SELECT zone, date, boro, num_orders, round(avg_amount, 6) AS avg_amount, round(total_vol, 4) AS total_vol FROM features"
)
def feature_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-days and volumes stored in buckets by borough and day, joined without moving a row."""
    zone_days, zones, volumes, _ = daily_tables(spark, sf_dir)
    keys, name = ["boro", "date"], uuid.uuid4().hex
    placed = zone_days.join(zones, "zone", "left")
    for side, df in (("zone_days", placed), ("volumes", volumes)):
        write_bucketed(df, f"{side}_{name}", scratch_path(spark, side), keys, buckets=16)
    joined = join_bucketed(spark, f"zone_days_{name}", f"volumes_{name}", keys)
    return rounded(joined.select("zone", "date", "boro", "num_orders", "avg_amount", "total_vol"), {"avg_amount": 6, "total_vol": 4})
