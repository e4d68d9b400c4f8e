"""The complete daily tables, fed from the given tables in the layout of the original feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.conform import union_sources
from daymill.operators.daily import sort_by_date
from daymill.period import Period
from daymill.plans import observations, trips, volumes
from daymill.queries.registry import query, rounded, rounded_sql, table, trim_sql
from daymill.session import clear_scratch, scratch_path
from daymill.sources import promote, read_parquet
from daymill.sources.scans import PERIOD_COLUMN

# --- Trips ----------------------------------------------------------------------

TRIP_PERIOD = Period.of("1995-10-01", "1998-03-31")
LATER_TRIP_PERIOD = Period.of("1998-04-01", "2000-06-30")

TRIP_FEED = {
    "VendorID": "l_linenumber",
    "pickup": "o_orderdate",
    "dropoff": "l_shipdate",
    "store_and_fwd_flag": "l_returnflag",
    "RatecodeID": "l_linenumber",
    "PULocationID": "CAST(length(o_orderpriority) AS BIGINT)",
    "DOLocationID": "l_suppkey",
    "passenger_count": "l_quantity",
    "trip_distance": "sqrt(o_totalprice) / l_quantity",
    "fare_amount": "sqrt(l_extendedprice) / l_quantity",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "sqrt(l_extendedprice) / l_quantity * l_discount",
    "tolls_amount": "sqrt(l_extendedprice) / l_quantity * l_tax",
    "improvement_surcharge": "CAST(0.3 AS DOUBLE)",
    "total_amount": "sqrt(l_extendedprice) / l_quantity * (1 + l_discount + l_tax) + l_quantity / 10",
    "payment_type": "l_linenumber",
    "congestion_surcharge": "l_discount * 10",
}
YELLOW_ONLY = {"Airport_fee": "l_tax * 20"}
GREEN_ONLY = {"ehail_fee": "CAST(NULL AS DOUBLE)", "trip_type": "l_linenumber"}

#: What the feeds are worked out from.
FED_COLUMNS = (
    "l_linenumber l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_shipdate "
    "o_orderdate o_orderpriority o_totalprice"
).split()


def landing_trips(spark: SparkSession, sf_dir: str) -> str:
    """Lines and their orders as monthly trip files of two sources, told apart by line status.

    Each source has its own layout: names, columns only it has, order of columns.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    joined = lines.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        *FED_COLUMNS,
        "CASE WHEN l_linestatus = 'F' THEN 'yellow_taxi' ELSE 'green_taxi' END AS source",
        f"date_format(o_orderdate, 'yyyy-MM') AS {PERIOD_COLUMN}",
    )
    both, landing = scratch_path(spark, "trips"), scratch_path(spark, "landing")
    joined.write.partitionBy("source").parquet(both)
    for spec, letter, only in ((trips.YELLOW, "t", YELLOW_ONLY), (trips.GREEN, "l", GREEN_ONLY)):
        # gathered by month as they came: the feed's columns are several times as wide
        gathered = read_parquet(spark, f"{both}/source={spec.name}").hint("rebalance", F.col(PERIOD_COLUMN))
        rows = gathered.selectExpr(*(f"{sql} AS {name}" for name, sql in (TRIP_FEED | only).items()), PERIOD_COLUMN)
        rows = rows.withColumnsRenamed({n: f"{letter}pep_{n}_datetime" for n in ("pickup", "dropoff")})
        if spec is trips.GREEN:
            rows = rows.select(*reversed(rows.columns))
        promote(rows, landing, spec.name)
    clear_scratch(spark, both)
    return landing


def trip_tables(spark: SparkSession, sf_dir: str, period: Period, **options) -> tuple[str, str]:
    """Landing files → raw layer → cleaned trips and zone-day averages, as a user builds them."""
    landing, raw = landing_trips(spark, sf_dir), scratch_path(spark, "raw")
    layout = f"{{source}}/{PERIOD_COLUMN}={{period}}"
    trips.promote_trips(spark, landing, raw, period, layout, missing="skip")
    return trips.build_trip_tables(spark, raw, scratch_path(spark, "curated"), period, **options)


# What the tables must hold, spelled out apart from the plan's own constants.
TRIP_SELECT = """
CAST(l_linenumber AS INTEGER) AS vendor_id, o_orderdate AS pep_pickup_datetime,
l_shipdate AS pep_dropoff_datetime, l_quantity AS passenger_count,
sqrt(o_totalprice) / l_quantity AS trip_distance, CAST(l_linenumber AS DOUBLE) AS ratecode_id,
CAST(length(o_orderpriority) AS BIGINT) AS pu_location_id, CAST(l_suppkey AS BIGINT) AS do_location_id,
CAST(l_linenumber AS DOUBLE) AS payment_type, sqrt(l_extendedprice) / l_quantity AS fare_amount,
l_discount AS extra, l_tax AS mta_tax, sqrt(l_extendedprice) / l_quantity * l_discount AS tip_amount,
sqrt(l_extendedprice) / l_quantity * l_tax AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
sqrt(l_extendedprice) / l_quantity * (1 + l_discount + l_tax) + l_quantity / 10 AS total_amount,
l_discount * 10 AS congestion_surcharge,
CASE WHEN l_linestatus = 'F' THEN l_tax * 20 ELSE 0 END AS airport_fee"""
TRIP_RULES = """passenger_count > 0 AND trip_distance > 0 AND ratecode_id >= 1 AND ratecode_id <= 6
AND payment_type >= 1 AND payment_type <= 6 AND fare_amount >= 2.5 AND extra >= 0 AND mta_tax >= 0
AND tip_amount >= 0 AND tolls_amount >= 0 AND improvement_surcharge >= 0 AND total_amount >= 0
AND congestion_surcharge >= 0 AND airport_fee >= 0 AND airport_fee <= 1.25"""
TRIP_TOTAL = """fare_amount + extra + mta_tax + tip_amount + improvement_surcharge
+ congestion_surcharge + tolls_amount + airport_fee"""
TRIP_TRIMS = (
    "passenger_count trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
    "total_amount congestion_surcharge airport_fee trip_time_hours"
).split()
TRIP_MEANS = (
    "fare_amount passenger_count trip_distance extra mta_tax tip_amount tolls_amount improvement_surcharge "
    "congestion_surcharge airport_fee"
).split()
TRIP_OUTPUT = (
    "vendor_id pep_pickup_datetime pep_dropoff_datetime passenger_count trip_distance ratecode_id "
    "pu_location_id do_location_id payment_type fare_amount extra mta_tax tip_amount tolls_amount "
    "improvement_surcharge total_amount congestion_surcharge airport_fee "
    "trip_time_hours calc_total_amount total_diff date"
).split()


def trips_sql(period: Period, last_day: str = "whole_day", enforce_total: bool = True) -> str:
    """CTEs down to ``cleaned``, one row per cleaned trip."""
    end = f"< '{period.day_after}'" if last_day == "whole_day" else f"<= '{period.end}'"
    tolerance = "WHERE total_diff <= 3" if enforce_total else ""
    return f"""
WITH united AS (SELECT {TRIP_SELECT} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ruled AS (SELECT * FROM united WHERE pep_pickup_datetime >= '{period.start}'
  AND pep_dropoff_datetime {end} AND {TRIP_RULES}),
timed AS (SELECT *, (floor(epoch(pep_dropoff_datetime)) - floor(epoch(pep_pickup_datetime))) / 3600
  AS trip_time_hours, {TRIP_TOTAL} AS calc_total_amount FROM ruled),
differing AS (SELECT *, round(abs(total_amount - calc_total_amount), 4) AS total_diff
  FROM timed WHERE trip_time_hours > 0.02),
valid AS MATERIALIZED (SELECT * FROM differing {tolerance}),
{trim_sql("valid", TRIP_TRIMS, "trimmed")},
cleaned AS (SELECT *, CAST(pep_pickup_datetime AS DATE) AS date FROM trimmed)"""


ZONE_DAY_DIGITS = {"avg_total_amount": 6, "avg_trip_time": 6}
ZONE_DAY_DIGITS |= {f"avg_{column}": 8 for column in TRIP_MEANS}
ZONE_DAY_DIGITS |= {"avg_amount_per_hour": 8, "daily_zone_revenue": 6}

ZONE_DAY_SQL = f"""
, daily AS (SELECT pu_location_id, date, count(*) AS num_pickups,
  avg((total_amount + calc_total_amount) / 2) AS avg_total_amount,
  avg(trip_time_hours) AS avg_trip_time,
  {", ".join(f"avg({column}) AS avg_{column}" for column in TRIP_MEANS)},
  avg((total_amount + calc_total_amount) / 2) / avg(trip_time_hours) AS avg_amount_per_hour,
  sum((total_amount + calc_total_amount) / 2) AS daily_zone_revenue
  FROM cleaned GROUP BY pu_location_id, date)
SELECT pu_location_id, date, num_pickups, {rounded_sql(ZONE_DAY_DIGITS)},
  CAST(isodow(date) AS INTEGER) AS day_of_week FROM daily"""


@query(f"{trips_sql(TRIP_PERIOD)} SELECT {', '.join(TRIP_OUTPUT)} FROM cleaned")
def trips_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = trip_tables(spark, sf_dir, TRIP_PERIOD)
    return trips.read_cleaned_trips(spark, path, TRIP_PERIOD)


@query(trips_sql(TRIP_PERIOD) + ZONE_DAY_SQL)
def trips_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = trip_tables(spark, sf_dir, TRIP_PERIOD)
    return sort_by_date(rounded(read_parquet(spark, path), ZONE_DAY_DIGITS), "date", "pu_location_id")


@query(trips_sql(LATER_TRIP_PERIOD, "midnight", enforce_total=False) + ZONE_DAY_SQL)
def trips_daily_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later period, with totals compared but not enforced and the last day cut off."""
    options = {"prefix": "later_", "last_day": "midnight", "enforce_total": False}
    _, path = trip_tables(spark, sf_dir, LATER_TRIP_PERIOD, **options)
    return sort_by_date(rounded(read_parquet(spark, path), ZONE_DAY_DIGITS), "date", "pu_location_id")


# --- Observations ---------------------------------------------------------------

OBSERVED_PERIOD = Period.of("2024-01-01", "2025-01-20")
FIRST_OBSERVED_PERIOD = Period.of("2024-01-01", "2024-01-20")
LATER_OBSERVED_PERIOD = Period.of("2025-01-21", "2025-01-30")
OBSERVED_YEARS = ("2024", "2025")

READINGS = {
    "temperature": "value",
    "dew_point_temperature": "sqrt(value)",
    "station_level_pressure": "k",
    "sea_level_pressure": "k * sqrt(value)",
    "wind_speed": "CAST(user_id AS DOUBLE)",
    "precipitation": "CASE WHEN k >= 5 THEN k END",
    "relative_humidity": "value / (user_id + 1)",
    "wet_bulb_temperature": "value + k",
}
READINGS_SQL = ", ".join(f"{sql} AS {name}" for name, sql in READINGS.items())


def landing_observations(spark: SparkSession, sf_dir: str) -> str:
    """Events as yearly text files, every second one moved to the next year; the path's template.

    Date parts are short text, readings text with ``T`` for some gaps. The files differ in
    the order of their columns and hold one column that nobody asks for.
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    parts = {
        "Year": (F.year("ts") + F.col("event_id") % 2).cast("string"),
        "Month": F.month("ts").cast("string"),
        "Day": F.dayofmonth("ts").cast("string"),
        "k": k,
    }
    readings = {name: F.expr(sql).cast("string").alias(name) for name, sql in READINGS.items()}
    readings["precipitation"] = F.coalesce(readings["precipitation"], F.lit("T")).alias("precipitation")
    feed = events.withColumns(parts).select("Year", "Month", "Day", "event_type", *readings.values())
    root = scratch_path(spark, "landing")
    for year, columns in zip(OBSERVED_YEARS, (feed.columns, feed.columns[::-1]), strict=True):
        own = feed.filter(F.col("Year") == year).select(*columns)
        own.write.csv(f"{root}/{year}.psv", header=True, sep=observations.SEPARATOR)
    return f"{root}/{{period}}.psv"


OBSERVED_SQL = f"""
WITH parsed AS (SELECT *, CAST(props->>'$.k' AS DOUBLE) AS k FROM events),
hourly AS (SELECT year(ts) + event_id % 2 AS Year, month(ts) AS Month, day(ts) AS Day,
  make_date(year(ts) + event_id % 2, month(ts), day(ts)) AS date, {READINGS_SQL} FROM parsed)"""
OBSERVED_TRIMS = (
    "Year Month Day temperature dew_point_temperature station_level_pressure sea_level_pressure "
    "wind_speed precipitation relative_humidity wet_bulb_temperature"
).split()


def observations_sql(period: Period) -> str:
    means = ", ".join(f"round(avg({c}), 8) AS mean_{c}" for c in OBSERVED_TRIMS[3:])
    return f"""{OBSERVED_SQL},
dated AS (SELECT * FROM hourly WHERE date BETWEEN '{period.start}' AND '{period.end}'),
{trim_sql("dated", OBSERVED_TRIMS, "kept")}
SELECT date, {means} FROM kept GROUP BY date"""


def _observed(spark: SparkSession, sf_dir: str, period: Period) -> DataFrame:
    """Text files → raw layer → curated means."""
    template, raw = landing_observations(spark, sf_dir), scratch_path(spark, "raw")
    path = observations.build_observation_table(
        spark, template, raw, scratch_path(spark, "curated"), period
    )
    digits = {f"mean_{name}": 8 for name in observations.MEASURES}
    return sort_by_date(rounded(read_parquet(spark, path), digits))


@query(observations_sql(OBSERVED_PERIOD))
def observations_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observed(spark, sf_dir, OBSERVED_PERIOD)


@query(observations_sql(LATER_OBSERVED_PERIOD))
def observations_daily_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observed(spark, sf_dir, LATER_OBSERVED_PERIOD)


@query(
    f"""{OBSERVED_SQL} SELECT CAST(Year AS VARCHAR) AS Year, count(*) AS num_rows,
    count(*) FILTER (date BETWEEN '{FIRST_OBSERVED_PERIOD.start}' AND '{FIRST_OBSERVED_PERIOD.end}'
      OR date BETWEEN '{LATER_OBSERVED_PERIOD.start}' AND '{LATER_OBSERVED_PERIOD.end}') AS num_dated
    FROM hourly GROUP BY 1"""
)
def observations_raw_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two periods built one after the other into one raw layer, which then holds both years whole."""
    template, raw = landing_observations(spark, sf_dir), scratch_path(spark, "raw")
    dated = []
    for period in (FIRST_OBSERVED_PERIOD, LATER_OBSERVED_PERIOD):
        observations.build_observation_table(
            spark, template, raw, scratch_path(spark, "curated"), period
        )
    for period in (FIRST_OBSERVED_PERIOD, LATER_OBSERVED_PERIOD):
        rows = observations.read_raw_observations(spark, raw, period)
        dated.append(observations.date_observations(rows, period).selectExpr("CAST(int(Year) AS STRING) AS Year", "0 AS raw", "1 AS dated"))
    whole = observations.read_raw_observations(spark, raw, OBSERVED_PERIOD)
    rows = union_sources([whole.selectExpr("Year", "1 AS raw", "0 AS dated"), *dated])
    return rows.groupBy("Year").agg(F.sum("raw").alias("num_rows"), F.sum("dated").alias("num_dated"))


@query(
    f"{OBSERVED_SQL} SELECT CAST(Year AS VARCHAR) AS period, CAST(Month AS VARCHAR) AS Month, "
    "CAST(Day AS VARCHAR) AS Day, temperature, precipitation, wind_speed FROM hourly"
)
def text_period_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly text files whose headers differ, united by name, each row with its file's year."""
    rows = observations.scan_observations(spark, landing_observations(spark, sf_dir), OBSERVED_YEARS)
    return rows.select("period", "Month", "Day", "temperature", "precipitation", "wind_speed")


# --- Volumes --------------------------------------------------------------------

VOLUME_PERIOD = Period.of("2024-01-01", "2024-01-20")


@query(
    "WITH dated AS (SELECT event_type AS boro, CAST(ts AS DATE) AS date, "
    "CASE WHEN copy = 1 THEN value END AS vol FROM events, (SELECT unnest([1, 2]) AS copy) "
    f"WHERE CAST(ts AS DATE) BETWEEN '{VOLUME_PERIOD.start}' AND '{VOLUME_PERIOD.end}'), "
    f"{trim_sql('dated', ['vol'], 'kept')} "
    "SELECT boro, date, round(sum(vol), 4) AS total_vol FROM kept GROUP BY boro, date"
)
def volumes_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text file → raw layer → curated totals; some rows have no number, some no date."""
    counts = table(spark, sf_dir, "events").select(
        F.year("ts").cast("string").alias("yr"),
        F.month("ts").cast("string").alias("m"),
        F.dayofmonth("ts").cast("string").alias("d"),
        F.col("event_type").alias("boro"),
        F.col("value").cast("string").alias("vol"),
    )
    odd = counts.withColumns({"vol": F.lit("n/a")}).union(counts.withColumns({"m": F.lit("13")}))
    landing = scratch_path(spark, "landing")
    counts.union(odd).select("vol", "yr", "m", "d", "boro").write.csv(landing, header=True)
    path = volumes.build_volume_table(
        spark, landing, scratch_path(spark, "raw"), scratch_path(spark, "curated"), VOLUME_PERIOD
    )
    return sort_by_date(rounded(read_parquet(spark, path), {"total_vol": 4}), "date", "boro")
