import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymill.operators.daily import add_day_of_week, daily_aggregate, join_back, sort_by_date
from daymill.operators.profile import (
    correlations,
    fetch_one,
    global_stats,
    profile,
    shape,
    shape_frame,
    show_profile,
)

SUNDAY, MONDAY = dt.date(2023, 1, 1), dt.date(2023, 1, 2)


@pytest.fixture(scope="module")
def trips(spark):
    rows = [
        (1, SUNDAY, 10.0, 1.0),
        (1, SUNDAY, 20.0, 4.0),
        (1, MONDAY, 5.0, None),
        (2, MONDAY, 6.0, 0.0),
        (None, MONDAY, 7.0, 2.0),
    ]
    return spark.createDataFrame(rows, "zone int, date date, amount double, hours double")


def by_key(df):
    return {(r["zone"], r["date"]): r.asDict() for r in df.collect()}


def test_count_means_sums_and_ratio_of_means(trips):
    daily = daily_aggregate(
        trips,
        ["zone", "date"],
        count="n",
        means={"avg_amount": "amount", "avg_hours": F.col("hours")},
        sums={"revenue": F.col("amount") * 2},
        ratios={"per_hour": ("avg_amount", "avg_hours")},
    )
    assert daily.columns == ["zone", "date", "n", "avg_amount", "avg_hours", "revenue", "per_hour"]
    found = by_key(daily)
    assert found[(1, SUNDAY)] == {
        "zone": 1,
        "date": SUNDAY,
        "n": 2,
        "avg_amount": 15.0,
        "avg_hours": 2.5,
        "revenue": 60.0,
        "per_hour": 6.0,
    }
    assert found[(1, MONDAY)]["avg_hours"] is None
    assert found[(2, MONDAY)]["per_hour"] is None
    assert found[(None, MONDAY)]["revenue"] == 14.0


def test_join_back_equals_one_aggregate_but_for_null_keys(trips):
    keys = ["zone", "date"]
    counts = daily_aggregate(trips, keys, count="n")
    sums = daily_aggregate(trips, keys, sums={"revenue": "amount"})
    joined = by_key(join_back(counts, sums, keys))
    fused = by_key(daily_aggregate(trips, keys, count="n", sums={"revenue": "amount"}))
    assert joined.pop((None, MONDAY))["revenue"] is None
    assert fused.pop((None, MONDAY))["revenue"] == 7.0
    assert joined == fused


def test_one_aggregate_needs_one_shuffle(spark, trips, tmp_path):
    trips.write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    daily = daily_aggregate(stored, ["zone", "date"], count="n", sums={"revenue": "amount"})
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan") == 1
    assert "partial_sum" in plan and "hours" not in plan


def test_day_of_week_and_sort(trips):
    ordered = sort_by_date(add_day_of_week(trips), "date", "zone").collect()
    assert [r["date"] for r in ordered] == [SUNDAY] * 2 + [MONDAY] * 3
    assert [r["day_of_week"] for r in ordered] == [7, 7, 1, 1, 1]
    assert [r["zone"] for r in ordered[2:]] == [None, 1, 2]


def test_profile_agrees_with_describe(trips):
    columns = ["zone", "amount", "hours"]
    found = {r["column_name"]: r.asDict() for r in profile(trips, columns).collect()}
    described = {r["summary"]: r.asDict() for r in trips.select(*columns).describe().collect()}
    for name in columns:
        assert found[name]["num_values"] == int(described["count"][name])
        for measure in ("mean", "stddev", "min", "max"):
            assert found[name][measure] == pytest.approx(float(described[measure][name]))


def test_show_profile_prints_vertically(trips, capsys):
    show_profile(trips, ["amount"])
    printed = capsys.readouterr().out
    assert "-RECORD 0" in printed and "amount" in printed and "hours" not in printed


def test_shape(trips):
    assert shape(trips) == (5, 4)
    assert tuple(shape_frame(trips).first()) == (5, 4)


def test_global_stats_and_fetch(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "a double")
    assert tuple(fetch_one(global_stats(df, "a"))) == (2.0, pytest.approx(2**0.5))


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, -1.0), (2.0, 4.0, -2.0), (3.0, 6.0, -3.0)], "y double, a double, b double")
    found = {r["column_name"]: r["correlation"] for r in correlations(df, "y", ["a", "b"]).collect()}
    assert found == {"a": pytest.approx(1.0), "b": pytest.approx(-1.0)}


def test_a_key_with_a_third_of_all_rows(spark, tmp_path):
    """Each task sends one partial row per key, however many rows the key has."""
    zone = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    rows = spark.range(0, 90_000, 1, 8).select(
        zone.alias("zone"), F.lit(MONDAY).alias("date"), F.col("id").cast("double").alias("amount")
    )
    daily = daily_aggregate(rows, ["zone", "date"], count="n", sums={"total": "amount"})
    expected = {}
    for i in range(90_000):
        key = 0 if i % 3 == 0 else i % 50
        n, total = expected.get(key, (0, 0.0))
        expected[key] = (n + 1, total + i)
    assert {r["zone"]: (r["n"], r["total"]) for r in daily.collect()} == expected
