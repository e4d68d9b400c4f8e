import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymill.operators.rules import Rule, apply_rules, filter_dates, filter_span, reconcile
from daymill.period import Period

NAN = float("nan")


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_every_rule_must_hold_and_null_fails(spark):
    rows = [(1, 1.0, 6.0), (2, 0.0, 6.0), (3, 1.0, 6.1), (4, None, 1.0), (5, 1.0, None), (6, NAN, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    kept = apply_rules(df, [Rule("a", ">", 0), Rule("b", ">=", 1), Rule("b", "<=", 6)])
    assert ids(kept) == [1, 6]  # NaN ranks above every number
    assert ids(apply_rules(kept, [Rule("a", "<=", 6)])) == [1]


def test_unknown_comparison_is_an_error():
    with pytest.raises(KeyError):
        Rule("a", "!=", 1).condition()


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("last_day, expected", [("whole_day", [1, 2, 3]), ("midnight", [1, 2])])
def test_last_day_of_a_span(spark, kind, last_day, expected):
    rows = [
        (0, "2022-09-30 23:59:59", "2022-10-01 00:10:00"),
        (1, "2022-10-01 00:00:00", "2022-10-01 00:10:00"),
        (2, "2023-03-30 23:50:00", "2023-03-31 00:00:00"),
        (3, "2023-03-31 12:00:00", "2023-03-31 23:59:59.999999"),
        (4, "2023-03-31 23:50:00", "2023-04-01 00:00:00"),
        (5, None, "2023-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    df = df.withColumns({"a": F.col("a").cast(kind), "b": F.col("b").cast(kind)})
    period = Period.of("2022-10-01", "2023-03-31")
    assert ids(filter_span(df, "a", "b", period, last_day)) == expected


def test_unknown_last_day_is_an_error(spark):
    with pytest.raises(ValueError):
        filter_span(spark.range(1), "id", "id", Period.of("2022-01-01", "2022-01-02"), "noon")


def test_dates_are_inclusive_on_both_ends(spark):
    days = [None, *(dt.date(2022, 9, 30) + dt.timedelta(days=n) for n in range(4))]
    df = spark.createDataFrame(list(enumerate(days)), "id int, date date")
    assert ids(filter_dates(df, "date", Period.of("2022-10-01", "2022-10-02"))) == [2, 3]


def test_reconciliation(spark):
    rows = [(1, 12.99), (2, 13.0), (3, 13.01), (4, 7.0), (5, 6.99), (6, None)]
    df = spark.createDataFrame(rows, "id int, total double")
    df = df.withColumns({"x": F.lit(4.0), "y": F.lit(6.0)})
    assert ids(reconcile(df, "total", ["x", "y"], 3)) == [1, 2, 4]
    flagged = reconcile(df, "total", ["x", "y"], 3, enforce=False)
    differences = {r["id"]: r["total_diff"] for r in flagged.collect()}
    assert differences == {1: 2.99, 2: 3.0, 3: 3.01, 4: 3.0, 5: 3.01, 6: None}


def test_periods():
    period = Period.of("2022-10-15", "2023-03-01")
    assert period.months() == ["2022-10", "2022-11", "2022-12", "2023-01", "2023-02", "2023-03"]
    assert period.years() == ["2022", "2023"]
    assert period.day_after == dt.date(2023, 3, 2)
    with pytest.raises(ValueError):
        Period.of("2022-10-15", "2022-10-14")
