"""Hourly observations → daily means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import date_from_parts
from daymill.operators.conform import cast_columns, union_sources
from daymill.operators.daily import daily_aggregate, sort_by_date
from daymill.operators.outliers import trim_outliers
from daymill.operators.rules import filter_dates
from daymill.period import Period
from daymill.sources import promote_at_once, read_promoted, scan_text_period, write_table
from daymill.sources.quarantine import promote_checked, read_accepted, read_checked
from daymill.sources.scans import PERIOD_COLUMN, period_paths

# --- Fixed values ---------------------------------------------------------------

DATE_PARTS = ("Year", "Month", "Day")

MEASURES = (
    "temperature",
    "dew_point_temperature",
    "station_level_pressure",
    "sea_level_pressure",
    "wind_speed",
    "precipitation",
    "relative_humidity",
    "wet_bulb_temperature",
)

SEPARATOR = "|"

SOURCE = "observations"

# --------------------------------------------------------------------------------


RAW_TYPES = dict.fromkeys(DATE_PARTS, "string") | dict.fromkeys(MEASURES, "double")


def scan_observations(spark: SparkSession, template: str, years: Sequence[str]) -> DataFrame:
    """The yearly text files, ``{period}`` in the template standing for the year.

    Date parts stay text, since their padding matters; measures become doubles.
    """
    return scan_text_period(spark, template, years, RAW_TYPES, SEPARATOR, stamp=PERIOD_COLUMN)


def promote_observations(spark: SparkSession, template: str, raw_root: str, years: Sequence[str], misfits: str = "null") -> str:
    """All rows of the yearly files into the raw layer, one folder per year; other years stay.

    Text that is no number turns null, or with ``misfits="quarantine"`` its whole line goes to the
    layer's quarantine, which ``sources.quarantine.read_quarantined`` shows.
    """
    if misfits == "quarantine":
        files = period_paths(template, years).items()
        checked = union_sources(
            read_checked(spark, path, RAW_TYPES, SEPARATOR).withColumn(PERIOD_COLUMN, F.lit(year)) for year, path in files
        )
        return promote_checked(checked, raw_root, SOURCE, periods=years)
    if misfits != "null":
        raise ValueError(f"misfits must be 'null' or 'quarantine', not {misfits!r}")
    observations = scan_observations(spark, template, years)
    return promote_at_once(observations, raw_root, SOURCE, periods=years)


def read_raw_observations(spark: SparkSession, raw_root: str, period: Period, misfits: str = "null") -> DataFrame:
    """Raw observations of the years a period touches, as promoted with the same ``misfits``."""
    if misfits == "quarantine":
        return read_accepted(spark, f"{raw_root}/{SOURCE}", RAW_TYPES, period.years())
    return read_promoted(spark, f"{raw_root}/{SOURCE}", RAW_TYPES, period.years())


def date_observations(observations: DataFrame, period: Period, pad: bool = True) -> DataFrame:
    """Observations of the period, all attributes as numbers."""
    dated = observations.withColumn("date", date_from_parts(*DATE_PARTS, pad=pad))
    typed = cast_columns(dated, dict.fromkeys(DATE_PARTS, "double"))
    return filter_dates(typed, "date", period)


def clean_observations(dated: DataFrame, **options) -> DataFrame:
    """Dated observations without outliers; every attribute must be present.

    The date parts are trimmed along with the measures, as numbers. The options are
    those of the trim.
    """
    return trim_outliers(dated, (*DATE_PARTS, *MEASURES), **options)


def daily_means(cleaned: DataFrame) -> DataFrame:
    return daily_aggregate(cleaned, ["date"], means={f"mean_{name}": name for name in MEASURES})


def build_observation_table(
    spark: SparkSession,
    template: str,
    raw_root: str,
    curated_path: str,
    period: Period,
    pad: bool = True,
    misfits: str = "null",
    **options,
) -> str:
    """Text files → typed raw layer → daily means; returns the path of the means.

    The raw layer takes the whole files of the years the period touches and leaves other
    years alone, so it serves any later period. The text is parsed once. The trim's scans
    read the columns they need from Parquet.
    """
    promote_observations(spark, template, raw_root, period.years(), misfits)
    dated = date_observations(read_raw_observations(spark, raw_root, period, misfits), period, pad)
    write_table(sort_by_date(daily_means(clean_observations(dated, **options))), curated_path)
    return curated_path
