"""Trips of two sources → cleaned trips and zone-day averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymill.functions import absolute_difference, component_total, duration_hours, midpoint
from daymill.operators.conform import SourceSpec, conform, union_sources
from daymill.operators.daily import add_day_of_week, daily_aggregate, sort_by_date
from daymill.operators.outliers import trim_outliers
from daymill.operators.rules import Rule, apply_rules, filter_span, reconcile, within_span
from daymill.operators.steps import Step, rule_steps, step_report, watch_steps
from daymill.period import Period
from daymill.sources import promote_at_once, read_promoted, scan_period, write_table
from daymill.sources.scans import PERIOD_COLUMN

# --- Fixed values ---------------------------------------------------------------

SOURCE_TYPES = {
    "VendorID": "int",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "long",
    "DOLocationID": "long",
    "payment_type": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

SHARED_NAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}

YELLOW = SourceSpec(
    name="yellow_taxi",
    types=SOURCE_TYPES,
    rename=SHARED_NAMES
    | {
        "tpep_pickup_datetime": "pep_pickup_datetime",
        "tpep_dropoff_datetime": "pep_dropoff_datetime",
    },
    drop=("store_and_fwd_flag",),
)

GREEN = SourceSpec(
    name="green_taxi",
    types=SOURCE_TYPES,
    rename=SHARED_NAMES
    | {
        "lpep_pickup_datetime": "pep_pickup_datetime",
        "lpep_dropoff_datetime": "pep_dropoff_datetime",
    },
    drop=("ehail_fee", "trip_type", "store_and_fwd_flag"),
    constants={"airport_fee": (0, "double")},
)

NUMERIC_COLUMNS = (
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "ratecode_id",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)

RULES = (
    Rule("passenger_count", ">", 0),
    Rule("trip_distance", ">", 0),
    Rule("ratecode_id", ">=", 1),
    Rule("ratecode_id", "<=", 6),
    Rule("payment_type", ">=", 1),
    Rule("payment_type", "<=", 6),
    Rule("fare_amount", ">=", 2.50),
    Rule("extra", ">=", 0),
    Rule("mta_tax", ">=", 0),
    Rule("tip_amount", ">=", 0),
    Rule("tolls_amount", ">=", 0),
    Rule("improvement_surcharge", ">=", 0),
    Rule("total_amount", ">=", 0),
    Rule("congestion_surcharge", ">=", 0),
    Rule("airport_fee", ">=", 0),
    Rule("airport_fee", "<=", 1.25),
)

MIN_TRIP_HOURS = 0.02

TOTAL_COMPONENTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "tolls_amount",
    "airport_fee",
)

TOTAL_TOLERANCE = 3

TRIMMED_COLUMNS = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "trip_time_hours",
)

AVERAGED_COLUMNS = (
    "fare_amount",
    "passenger_count",
    "trip_distance",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# --------------------------------------------------------------------------------

PICKUP, DROPOFF = "pep_pickup_datetime", "pep_dropoff_datetime"

TRIP_COLUMNS = (NUMERIC_COLUMNS[0], PICKUP, DROPOFF, *NUMERIC_COLUMNS[1:])


def trip_types(datetime_type: str = "timestamp_ntz") -> dict[str, str]:
    """Column → type of a conformed trip."""
    types = {SHARED_NAMES.get(name, name): kind for name, kind in SOURCE_TYPES.items()}
    types |= {PICKUP: datetime_type, DROPOFF: datetime_type}
    return {name: types[name] for name in TRIP_COLUMNS}


def conform_trips(df: DataFrame, spec: SourceSpec) -> DataFrame:
    return conform(df, spec, TRIP_COLUMNS)


def scan_landing(
    spark: SparkSession,
    template: str,
    spec: SourceSpec,
    period: Period,
    stamp: str | None = None,
    missing: str = "error",
) -> DataFrame:
    """A source's monthly files, ``{period}`` in the template standing for ``YYYY-MM``."""
    return scan_period(
        spark, template, period.months(), lambda df: conform_trips(df, spec), stamp, missing
    )


def trip_steps(period: Period, last_day: str = "whole_day", enforce_total: bool = True) -> list[Step]:
    """What ``validate_trips`` asks of a trip, step by step."""
    steps = [Step("inside the period", within_span(PICKUP, DROPOFF, period, last_day)), *rule_steps(RULES)]
    steps.append(Step("minimum duration", duration_hours(PICKUP, DROPOFF) > MIN_TRIP_HOURS))
    if enforce_total:
        difference = absolute_difference("total_amount", component_total(TOTAL_COMPONENTS))
        steps.append(Step("total reconciled", difference <= TOTAL_TOLERANCE))
    return steps


def validate_trips(
    trips: DataFrame,
    period: Period,
    last_day: str = "whole_day",
    enforce_total: bool = True,
    observation: Observation | None = None,
) -> DataFrame:
    """Trips of the period that pass the rules, with duration and recomputed total.

    ``observation`` counts what fails each of ``trip_steps``, with the first action on the result.
    """
    if observation is not None:
        trips = watch_steps(trips, trip_steps(period, last_day, enforce_total), observation)
    trips = filter_span(trips, PICKUP, DROPOFF, period, last_day)
    trips = apply_rules(trips, RULES)
    trips = trips.withColumn("trip_time_hours", duration_hours(PICKUP, DROPOFF))
    trips = trips.filter(F.col("trip_time_hours") > MIN_TRIP_HOURS)
    return reconcile(trips, "total_amount", TOTAL_COMPONENTS, TOTAL_TOLERANCE, enforce_total)


def clean_trips(
    trips: DataFrame,
    period: Period,
    last_day: str = "whole_day",
    enforce_total: bool = True,
    trimmed: Sequence[str] = TRIMMED_COLUMNS,
    observation: Observation | None = None,
    **options,
) -> DataFrame:
    """Validated trips without outliers, dated by pickup.

    ``last_day="midnight", enforce_total=False`` keeps the rows a literal reading of
    the original recipe keeps: the last day is cut off at its first instant, and
    totals are compared but not acted on. Further options are those of the trim.
    """
    valid = validate_trips(trips, period, last_day, enforce_total, observation)
    kept = trim_outliers(valid, trimmed, **options)
    return kept.withColumn("date", F.to_date(PICKUP))


def zone_day_averages(cleaned: DataFrame) -> DataFrame:
    """Pickups, means, revenue and amount per hour of each pickup zone and day."""
    total = midpoint("total_amount", "calc_total_amount")
    means = {"avg_total_amount": total, "avg_trip_time": "trip_time_hours"}
    means |= {f"avg_{column}": column for column in AVERAGED_COLUMNS}
    daily = daily_aggregate(
        cleaned,
        ["pu_location_id", "date"],
        count="num_pickups",
        means=means,
        sums={"daily_zone_revenue": total},
        ratios={"avg_amount_per_hour": ("avg_total_amount", "avg_trip_time")},
    )
    return add_day_of_week(
        daily.select(
            "pu_location_id",
            "date",
            "num_pickups",
            *means,
            "avg_amount_per_hour",
            "daily_zone_revenue",
        )
    )


def promote_trips(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    period: Period,
    layout: str = "{source}/{period}.parquet",
    missing: str = "error",
) -> dict[str, str]:
    """Conform the monthly landing files of both sources into their own raw paths.

    The months of the period are replaced, others stay.
    """
    paths = {}
    for spec in (YELLOW, GREEN):
        template = f"{landing_root}/{layout}".replace("{source}", spec.name)
        rows = scan_landing(spark, template, spec, period, PERIOD_COLUMN, missing)
        paths[spec.name] = promote_at_once(rows, raw_root, spec.name, periods=period.months())
    return paths


def read_raw_trips(
    spark: SparkSession, raw_root: str, period: Period, datetime_type: str = "timestamp_ntz"
) -> DataFrame:
    """Both promoted sources as one frame, months of the period only."""
    types = trip_types(datetime_type)
    return union_sources(
        read_promoted(spark, f"{raw_root}/{spec.name}", types, period.months())
        for spec in (YELLOW, GREEN)
    )


def build_trip_tables(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    period: Period,
    prefix: str = "",
    datetime_type: str = "timestamp_ntz",
    report: str | None = None,
    **options,
) -> tuple[str, str]:
    """Write cleaned trips and zone-day averages of a period; return their paths.

    Cleaned trips have a folder per month, and only those of the period are written. The
    averages are taken from the cleaned table as written, so validation and trim run
    once. A later period is another call with its own ``period`` and ``prefix``. ``report``
    names a path for the rows that each cleaning step dropped, counted by the trim's first scan.
    """
    averages_path = f"{curated_root}/{prefix}zone_day_averages"
    raw = read_raw_trips(spark, raw_root, period, datetime_type)
    counts = Observation() if report else None
    cleaned = clean_trips(raw, period, observation=counts, **options)
    monthly = cleaned.withColumn(PERIOD_COLUMN, F.date_format("date", "yyyy-MM"))
    cleaned_path = promote_at_once(
        monthly, curated_root, f"{prefix}cleaned_trips", rebalance=True, periods=period.months()
    )
    averages = zone_day_averages(read_cleaned_trips(spark, cleaned_path, period, datetime_type))
    write_table(sort_by_date(averages, "date", "pu_location_id"), averages_path)
    if report:
        judged = {name: options[name] for name in ("last_day", "enforce_total") if name in options}
        write_table(step_report(spark, trip_steps(period, **judged), counts), report)
    return cleaned_path, averages_path


def read_cleaned_trips(
    spark: SparkSession, path: str, period: Period, datetime_type: str = "timestamp_ntz"
) -> DataFrame:
    """Cleaned trips of the months of a period, without those of other months."""
    measures = dict.fromkeys(("trip_time_hours", "calc_total_amount", "total_diff"), "double")
    types = trip_types(datetime_type) | measures | {"date": "date"}
    return read_promoted(spark, path, types, period.months())
