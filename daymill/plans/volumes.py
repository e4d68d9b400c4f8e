"""Volume counts → totals per borough and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import date_from_parts
from daymill.operators.daily import daily_aggregate, sort_by_date
from daymill.operators.outliers import trim_outliers
from daymill.operators.rules import filter_dates
from daymill.period import Period
from daymill.sources import promote_at_once, read_delimited, read_promoted, write_table
from daymill.sources.scans import PERIOD_COLUMN

# --- Fixed values ---------------------------------------------------------------

COUNT_TYPES = {"yr": "string", "m": "string", "d": "string", "boro": "string", "vol": "double"}

SOURCE = "volumes"

UNDATED = "undated"

# --------------------------------------------------------------------------------


def scan_volumes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, COUNT_TYPES)


def promote_volumes(spark: SparkSession, path: str, raw_root: str) -> str:
    """All rows of the text file into the raw layer, dated, one folder per year.

    Rows whose parts form no date are kept in a folder of their own. Rows are not gathered by
    year first: years are few, and a task then sorts one split of the text, however many rows a year has.
    """
    counts = scan_volumes(spark, path)
    dated = counts.withColumn("date", date_from_parts("yr", "m", "d"))
    year = F.coalesce(F.date_format("date", "yyyy"), F.lit(UNDATED))
    return promote_at_once(dated.withColumn(PERIOD_COLUMN, year), raw_root, SOURCE)


def read_raw_volumes(spark: SparkSession, raw_root: str, period: Period) -> DataFrame:
    """Raw counts of the period; only folders of its years are read."""
    raw = read_promoted(spark, f"{raw_root}/{SOURCE}", COUNT_TYPES | {"date": "date"}, period.years())
    return filter_dates(raw.select("boro", "date", "vol"), "date", period)


def clean_volumes(dated: DataFrame, **options) -> DataFrame:
    return trim_outliers(dated, ["vol"], **options)


def borough_day_volumes(cleaned: DataFrame) -> DataFrame:
    return daily_aggregate(cleaned, ["boro", "date"], sums={"total_vol": "vol"})


def build_volume_table(
    spark: SparkSession, source: str, raw_root: str, curated_path: str, period: Period, **options
) -> str:
    """Text file → typed raw layer → totals; returns the path of the totals."""
    promote_volumes(spark, source, raw_root)
    cleaned = clean_volumes(read_raw_volumes(spark, raw_root, period), **options)
    write_table(sort_by_date(borough_day_volumes(cleaned), "date", "boro"), curated_path)
    return curated_path
