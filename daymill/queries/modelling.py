"""Feature table and linear regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import ratio
from daymill.operators.daily import daily_aggregate
from daymill.period import Period
from daymill.plans.model import build_model, feature_table
from daymill.queries.registry import query, rounded, table
from daymill.session import clear_scratch, scratch_path
from daymill.sources import read_parquet, write_table

TRAINING = Period.of("1995-01-01", "1998-12-31")
LATER = Period.of("1999-01-01", "2001-12-31")
FEATURES = ("total_vol", "mean_discount")
LABEL = "avg_amount"


def daily_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Zone-days, zones, volumes and days: nations as zones, regions as boroughs, order prices as amounts."""
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    zones = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS zone", "n_regionkey AS boro")

    placed = orders.join(customers, F.expr("o_custkey = c_custkey"))
    zone_days = daily_aggregate(
        placed.withColumnRenamed("c_nationkey", "zone"),
        ["zone", "date"],
        count="num_orders",
        means={LABEL: "o_totalprice"},
    )
    located = suppliers.join(zones, F.expr("s_nationkey = zone"))
    # one pass over the lines: written, since days are rolled up from boroughs and days
    path = scratch_path(spark, "shipped")
    shipped_now = (
        lines.join(located, F.expr("l_suppkey = s_suppkey"), "left")
        .groupBy("boro", "date")
        .agg(F.sum("l_quantity").alias("total_vol"), F.sum("l_discount").alias("d"), F.count("l_discount").alias("n"))
    )
    write_table(shipped_now, path)
    shipped = spark.read.schema(shipped_now.schema).parquet(path)
    volumes = shipped.filter("boro IS NOT NULL").select("boro", "date", "total_vol")
    days = shipped.groupBy("date").agg(ratio(F.sum("d"), F.sum("n")).alias("mean_discount"))
    return zone_days, zones, volumes, days


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(*daily_tables(spark, sf_dir), zone="zone")


def model(spark: SparkSession, sf_dir: str, scored: Period) -> dict[str, str]:
    """Curated daily tables as stored, then features, model and scores from them."""
    zone_days, zones, volumes, days = daily_tables(spark, sf_dir)
    root = scratch_path(spark, "model")
    curated = {"zone_days": zone_days, "volumes": volumes, "observations": days}
    for name, df in curated.items():
        write_table(df, f"{root}/{name}")
    paths = {name: f"{root}/{name}" for name in curated}
    return build_model(spark, paths, zones, root, FEATURES, LABEL, TRAINING, scored, zone="zone")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """A small result, kept apart from the scratch it was read from, which goes."""
    result = read_parquet(spark, path)
    rows, schema = result.collect(), result.schema
    clear_scratch(spark, path.rsplit("/", 1)[0])
    return spark.createDataFrame(rows, schema)


FEATURES_SQL = """
WITH zone_days AS (SELECT c_nationkey AS zone, CAST(o_orderdate AS DATE) AS date,
  count(*) AS num_orders, avg(o_totalprice) AS avg_amount
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
volumes AS (SELECT n_regionkey AS boro, CAST(l_shipdate AS DATE) AS date,
  sum(l_quantity) AS total_vol FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
days AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS mean_discount
  FROM lineitem GROUP BY 1),
features AS (SELECT zone, z.date, n_regionkey AS boro, num_orders, avg_amount, total_vol,
  mean_discount FROM zone_days z LEFT JOIN nation ON zone = n_nationkey
  LEFT JOIN volumes v ON n_regionkey = v.boro AND z.date = v.date
  LEFT JOIN days d ON z.date = d.date)"""

FIT_SQL = f"""
, m AS (SELECT avg(avg_amount) AS ym, avg(total_vol) AS am, avg(mean_discount) AS bm,
  var_pop(total_vol) AS aa, var_pop(mean_discount) AS bb,
  covar_pop(total_vol, mean_discount) AS ab, covar_pop(total_vol, avg_amount) AS az,
  covar_pop(mean_discount, avg_amount) AS bz FROM features
  WHERE date BETWEEN '{TRAINING.start}' AND '{TRAINING.end}'
  AND total_vol IS NOT NULL AND mean_discount IS NOT NULL),
slopes AS (SELECT *, (az * bb - bz * ab) / (aa * bb - ab * ab) AS a,
  (bz * aa - az * ab) / (aa * bb - ab * ab) AS b FROM m),
line AS (SELECT a, b, ym - a * am - b * bm AS c FROM slopes)"""


@query(
    f"{FEATURES_SQL} SELECT zone, date, boro, num_orders, round(avg_amount, 6) AS avg_amount, "
    "round(total_vol, 4) AS total_vol, round(mean_discount, 8) AS mean_discount FROM features"
)
def feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = {"avg_amount": 6, "total_vol": 4, "mean_discount": 8}
    return rounded(features(spark, sf_dir), digits)


@query(
    f"{FEATURES_SQL} {FIT_SQL} SELECT 'intercept' AS term, round(c, 3) AS value FROM line "
    "UNION ALL SELECT 'total_vol', round(a, 3) FROM line "
    "UNION ALL SELECT 'mean_discount', round(b, 3) FROM line"
)
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, model(spark, sf_dir, LATER)["coefficients"])
    return rounded(stored, {"value": 3})


SCORED_SQL = f"""{FEATURES_SQL} {FIT_SQL}, scored AS (SELECT avg_amount AS y,
  c + a * total_vol + b * mean_discount AS p FROM features, line
  WHERE date BETWEEN '{LATER.start}' AND '{LATER.end}')"""


@query(
    f"{SCORED_SQL} SELECT count(*) AS num_rows, "
    "round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae, "
    "round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2 FROM scored WHERE p IS NOT NULL"
)
def linear_regression_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of one period judged on a later one."""
    quality = _stored(spark, model(spark, sf_dir, LATER)["quality"])
    return rounded(quality, {"rmse": 3, "mae": 3, "r2": 8})


@query(
    f"{SCORED_SQL} SELECT count(*) AS num_rows, count(p) AS num_scored, "
    "round(avg(p), 3) AS mean_prediction FROM scored"
)
def score_keeps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-days without a feature stay, with a null prediction."""
    scored = read_parquet(spark, model(spark, sf_dir, LATER)["scored"])
    totals = scored.agg(
        F.count("*").alias("num_rows"),
        F.count("prediction").alias("num_scored"),
        F.mean("prediction").alias("mean_prediction"),
    )
    return rounded(totals, {"mean_prediction": 3})
