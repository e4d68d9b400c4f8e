import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymill.functions import (
    absolute_difference,
    component_total,
    date_from_parts,
    duration_hours,
    iso_day_of_week,
    midpoint,
    ratio,
)


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_duration_counts_whole_seconds(spark, kind):
    rows = [
        ("2022-10-01 00:00:00", "2022-10-01 00:01:12"),
        ("2022-10-01 00:00:00", "2022-10-01 00:01:13.9"),
        ("2022-10-01 01:00:00", "2022-10-01 00:00:00"),
        (None, "2022-10-01 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "a string, b string")
    df = df.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"))
    assert values(df, duration_hours("a", "b")) == [72 / 3600, 73 / 3600, -1.0, None]


def test_totals_are_null_if_a_component_is(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.5), (1.0, None, 3.5)], "a double, b double, c double")
    assert values(df, component_total(["a", "b", "c"])) == [6.5, None]
    assert values(df, midpoint("a", "c")) == [2.25, 2.25]


def test_difference_is_absolute_and_rounded(spark):
    df = spark.createDataFrame([(1.0, 4.00004), (4.00006, 1.0), (None, 1.0)], "a double, b double")
    assert values(df, absolute_difference("a", "b")) == [3.0, 3.0001, None]


def test_date_from_parts(spark):
    rows = [
        ("2022", "1", "5"),
        ("2022", "01", "05"),
        ("2022", "12", "31"),
        ("2022", "13", "01"),
        ("2022", "02", "30"),
        ("2022", "", "01"),
        ("2022", None, "01"),
        ("x", "01", "01"),
    ]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    fifth, last = dt.date(2022, 1, 5), dt.date(2022, 12, 31)
    assert values(df, date_from_parts("y", "m", "d")) == [fifth, fifth, last] + [None] * 5
    unpadded = values(df, date_from_parts("y", "m", "d", pad=False))
    assert unpadded == [None, fifth, last] + [None] * 5


def test_date_from_integer_parts(spark):
    df = spark.createDataFrame([(2024, 2, 9)], "y int, m int, d int")
    assert values(df, date_from_parts("y", "m", "d")) == [dt.date(2024, 2, 9)]


def test_iso_day_of_week_agrees_with_the_calendar(spark):
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=n) for n in range(730)]
    df = spark.createDataFrame([(day,) for day in days], "day date")
    assert values(df, iso_day_of_week("day")) == [day.isoweekday() for day in days]


def test_ratio_over_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert values(df, ratio("a", "b")) == [0.5, None, None]


def test_parts_of_three_characters_form_no_date(spark):
    parts = spark.createDataFrame([("2023", "123", "015"), ("2023", "1", "015"), ("2023", "12", "9")], "y string, m string, d string")
    found = parts.select(date_from_parts("y", "m", "d").alias("day")).collect()
    assert [str(r["day"]) for r in found] == ["None", "None", "2023-12-09"]
