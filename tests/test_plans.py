"""The complete tables from files on disk, checked against hand-made figures."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymill.__main__ import main
from daymill.period import Period
from daymill.plans import observations, trips, volumes
from daymill.queries import daily_tables
from daymill.sources.quarantine import read_quarantined

PERIOD = Period.of("2022-10-01", "2022-11-30")
LATER = Period.of("2022-12-01", "2022-12-31")


def trip(pickup, minutes=10, zone=1, fare=10.0, total=None, **other):
    start = dt.datetime.fromisoformat(pickup)
    row = {
        "VendorID": 1,
        "pickup": start,
        "dropoff": start + dt.timedelta(minutes=minutes),
        "passenger_count": 1.0,
        "trip_distance": 2.0,
        "RatecodeID": 1.0,
        "store_and_fwd_flag": "N",
        "PULocationID": zone,
        "DOLocationID": 5,
        "payment_type": 1,
        "fare_amount": fare,
        "extra": 0.5,
        "mta_tax": 0.5,
        "tip_amount": 1.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 0.3,
        "total_amount": fare + 2.3 if total is None else total,
        "congestion_surcharge": 0.0,
    }
    return row | other


TYPES = {
    "VendorID": "long",
    "pickup": "timestamp_ntz",
    "dropoff": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "long",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
}


def landing_file(spark, root, source, month, rows):
    schema = ", ".join(f"{name} {kind}" for name, kind in TYPES.items())
    df = spark.createDataFrame([tuple(row[name] for name in TYPES) for row in rows], schema)
    letter = source[0].replace("y", "t").replace("g", "l")
    df = df.withColumnsRenamed({n: f"{letter}pep_{n}_datetime" for n in ("pickup", "dropoff")})
    if source == "yellow_taxi":
        df = df.withColumn("Airport_fee" if month == "2022-11" else "airport_fee", F.lit(0.0))
    else:
        df = df.withColumns({"ehail_fee": F.lit(None).cast("int"), "trip_type": F.lit(1)})
        df = df.select(*reversed(df.columns))
    df.write.parquet(f"{root}/{source}/{month}.parquet")


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("trips")
    landing, raw = f"{root}/landing", f"{root}/raw"
    good = [trip(f"2022-10-03 08:{n:02d}:00", fare=10.0 + n % 3) for n in range(30)]
    bad = [
        trip("2022-10-03 09:00:00", passenger_count=0.0),
        trip("2022-10-03 09:00:00", trip_distance=None),
        trip("2022-10-03 09:00:00", RatecodeID=99.0),
        trip("2022-10-03 09:00:00", payment_type=0),
        trip("2022-10-03 09:00:00", fare=2.49),
        trip("2022-10-03 09:00:00", minutes=1.2),
        trip("2022-10-03 09:00:00", minutes=-5),
        trip("2022-10-03 09:00:00", total=15.31),
        trip("2022-09-30 23:59:00"),
    ]
    outlier = [trip("2022-10-03 10:00:00", fare=900.0)]
    november = [trip("2022-11-30 12:00:00", zone=2, fare=11.0), trip("2022-11-06 12:00:00", zone=2)]
    green = [trip("2022-10-03 08:00:00", zone=3, fare=11.0), trip("2022-10-04 08:00:00", zone=None)]
    december = [trip(f"2022-12-05 08:{n:02d}:00", fare=10.0 + n % 2) for n in range(10)]
    landing_file(spark, landing, "yellow_taxi", "2022-10", good + bad + outlier)
    landing_file(spark, landing, "yellow_taxi", "2022-11", november)
    landing_file(spark, landing, "yellow_taxi", "2022-12", december)
    landing_file(spark, landing, "green_taxi", "2022-10", green)
    landing_file(spark, landing, "green_taxi", "2022-11", green[:0])
    landing_file(spark, landing, "green_taxi", "2022-12", december[:1])
    trips.promote_trips(spark, landing, raw, PERIOD)
    return raw, f"{root}/curated"


def test_trip_tables(spark, roots):
    raw, curated = roots
    assert trips.read_raw_trips(spark, raw, PERIOD).count() == 44
    cleaned_path, averages_path = trips.build_trip_tables(spark, raw, curated, PERIOD)
    cleaned, averages = trips.read_cleaned_trips(spark, cleaned_path, PERIOD), spark.read.parquet(averages_path)

    assert cleaned.count() == 34
    assert cleaned.columns == [
        *trips.TRIP_COLUMNS,
        "trip_time_hours",
        "calc_total_amount",
        "total_diff",
        "date",
    ]
    assert cleaned.agg(F.max("fare_amount")).first()[0] == 12.0

    assert averages.columns[:4] == ["pu_location_id", "date", "num_pickups", "avg_total_amount"]
    assert averages.columns[-3:] == ["avg_amount_per_hour", "daily_zone_revenue", "day_of_week"]
    assert averages.agg(F.sum("num_pickups")).first()[0] == 34
    found = {(r["pu_location_id"], str(r["date"])): r for r in averages.collect()}
    busy = found[(1, "2022-10-03")]
    assert busy["num_pickups"] == 30
    assert busy["avg_fare_amount"] == pytest.approx(11.0)
    assert busy["avg_total_amount"] == pytest.approx(13.3)
    assert busy["daily_zone_revenue"] == pytest.approx(13.3 * 30)
    assert busy["avg_amount_per_hour"] == pytest.approx(13.3 * 6)
    assert busy["day_of_week"] == 1
    assert found[(3, "2022-10-03")]["avg_airport_fee"] == 0.0
    assert found[(2, "2022-11-30")]["num_pickups"] == 1
    assert found[(2, "2022-11-06")]["day_of_week"] == 7
    assert found[(None, "2022-10-04")]["daily_zone_revenue"] == pytest.approx(12.3)
    dates = [r["date"] for r in averages.collect()]
    assert dates == sorted(dates)


def test_literal_reading_of_the_recipe(spark, roots):
    raw = trips.read_raw_trips(spark, roots[0], PERIOD)
    literal = trips.validate_trips(raw, PERIOD, last_day="midnight", enforce_total=False)
    default = trips.validate_trips(raw, PERIOD)
    assert default.count() == 35
    assert default.filter("date(pep_pickup_datetime) = '2022-11-30'").count() == 1
    assert literal.count() == 35
    assert literal.filter("date(pep_pickup_datetime) = '2022-11-30'").count() == 0
    assert [r["total_diff"] for r in literal.filter("total_diff > 3").collect()] == [3.01]


def test_later_period_from_the_command_line(spark, roots):
    raw, curated = roots
    landing = raw.replace("/raw", "/landing")
    folders = ["--landing", landing, "--raw", raw, "--curated", curated]
    dates = ["--start", str(LATER.start), "--end", str(LATER.end)]
    main(["trips", *folders, *dates, "--prefix", "later_", "--keep-differing-totals"])
    assert spark.read.parquet(f"{curated}/later_cleaned_trips").count() == 11
    averages = spark.read.parquet(f"{curated}/later_zone_day_averages").collect()
    assert [r["num_pickups"] for r in averages] == [11]
    assert trips.read_raw_trips(spark, raw, PERIOD).count() == 44  # earlier months stay


def test_filters_and_columns_reach_the_scans(spark, roots):
    valid = trips.validate_trips(trips.read_raw_trips(spark, roots[0], PERIOD), PERIOD)
    plan = valid.select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2  # one per source
    for scan in scans:
        assert "GreaterThanOrEqual(fare_amount,2.5)" in scan
        assert "GreaterThanOrEqual(pep_pickup_datetime" in scan
        assert "vendor_id" not in scan and "do_location_id" not in scan
    assert "Python" not in plan


def test_cleaned_trips_are_kept_by_month(spark, roots):
    raw, curated = roots
    october = Period.of("2022-10-01", "2022-10-31")
    path, _ = trips.build_trip_tables(spark, raw, curated, PERIOD, prefix="monthly_")
    whole = trips.read_cleaned_trips(spark, path, PERIOD).count()
    one = trips.read_cleaned_trips(spark, path, october)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*period", plan)
    assert 0 < one.count() < whole
    trips.build_trip_tables(spark, raw, curated, october, prefix="monthly_")
    assert trips.read_cleaned_trips(spark, path, PERIOD).count() == whole  # November stays


def test_observation_table(spark, tmp_path):
    header = "Year|Month|Day|station|" + "|".join(observations.MEASURES)

    def lines(year, month, day, temperatures):
        return [f"{year}|{month}|{day}|X|{t}|1|2|3|4|5|6|7" for t in temperatures]

    first = lines(2022, 10, 1, [10, 12, "", "T", 14] + [12] * 17) + lines(2022, 9, 30, [99])
    first += lines(2022, 11, 2, [11 + n % 3 for n in range(40)] + [500])
    (tmp_path / "2022.psv").write_text("\n".join([header, *first]) + "\n")
    second = lines(2023, 1, 5, [12]) + ["2023|1|6|X|12||2|3|4|5|6|7"] + lines(2023, 2, 30, [12])
    (tmp_path / "2023.psv").write_text("\n".join([header, *second]) + "\n")
    path = str(tmp_path / "daily")
    folders = ["--landing", f"{tmp_path}/{{period}}.psv", "--raw", str(tmp_path / "raw"), "--curated", path]
    main(["observations", *folders, "--start", "2022-10-01", "--end", "2023-03-31"])
    daily = spark.read.parquet(path)
    assert daily.columns == ["date", *(f"mean_{name}" for name in observations.MEASURES)]
    found = [(str(r["date"]), r["mean_temperature"]) for r in daily.collect()]
    assert [day for day, _ in found] == ["2022-10-01", "2022-11-02"]
    assert found[0][1] == 12.0
    assert found[1][1] == pytest.approx(sum(11 + n % 3 for n in range(40)) / 40)
    assert daily.first()["mean_wet_bulb_temperature"] == 7.0

    def raw_rows():
        both = Period.of("2022-01-01", "2023-12-31")
        return observations.read_raw_observations(spark, str(tmp_path / "raw"), both).count()

    assert raw_rows() == len(first) + len(second)  # rows of other days and without a date as well
    main(["observations", *folders, "--start", "2023-01-01", "--end", "2023-01-31"])
    assert raw_rows() == len(first) + len(second)


def test_observed_year_is_trimmed_like_a_measure(spark):
    """The single row of 2023 lies beyond the bound of the year column."""
    rows = [("2022", "10", "01", *[1.0] * 8)] * 43 + [("2023", "01", "05", *[1.0] * 8)]
    names = [*observations.DATE_PARTS, *observations.MEASURES]
    kinds = ["string"] * 3 + ["double"] * 8
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    dated = observations.date_observations(df, Period.of("2022-10-01", "2023-03-31"))
    assert dated.count() == 44
    assert observations.clean_observations(dated).count() == 43


def test_volume_table(spark, tmp_path):
    rows = [f"2022,{10 + n % 2},{1 + n % 9},{'Bronx' if n % 3 else 'Queens'},{n % 7},x" for n in range(60)]
    rows += ["2022,10,1,Bronx,90000,x", "2022,10,1,Bronx,n/a,x", "2022,13,1,Bronx,1,x", "2021,1,1,Bronx,1,x"]
    source = tmp_path / "volumes.csv"
    source.write_text("\n".join(["yr,m,d,boro,vol,note", *rows]) + "\n")
    daily = str(tmp_path / "daily")
    folders = ["--landing", str(source), "--raw", str(tmp_path / "raw"), "--curated", daily]
    main(["volumes", *folders, "--start", "2022-10-01", "--end", "2023-03-31"])
    totals = spark.read.parquet(daily)
    assert dict(totals.dtypes) == {"boro": "string", "date": "date", "total_vol": "double"}
    assert totals.agg(F.sum("total_vol")).first()[0] == sum(n % 7 for n in range(60))
    assert spark.read.parquet(str(tmp_path / "raw" / volumes.SOURCE)).count() == len(rows)
    keys = [(r["date"], r["boro"]) for r in totals.collect()]
    assert keys == sorted(keys)


def test_trip_steps_are_reported(spark, roots, tmp_path):
    raw, curated = roots
    report = str(tmp_path / "report")
    cleaned_path, _ = trips.build_trip_tables(spark, raw, curated, PERIOD, prefix="counted_", report=report)
    rows = spark.read.parquet(report).orderBy("position").collect()
    assert rows[0].num_left == 44
    valid = trips.validate_trips(trips.read_raw_trips(spark, raw, PERIOD), PERIOD)
    assert rows[-1].num_left == valid.count() and rows[-1].step == "total reconciled"
    assert all(after.num_left == before.num_left - after.num_failed_first for before, after in zip(rows, rows[1:], strict=False))
    failed = {r.step: r.num_failed for r in rows}
    assert failed["fare_amount >= 2.5"] >= 1 and failed["minimum duration"] >= 2 and failed["inside the period"] >= 1
    assert trips.read_cleaned_trips(spark, cleaned_path, PERIOD).count() == 34


def test_observations_that_do_not_fit_are_kept_apart(spark, tmp_path):
    names = (*observations.DATE_PARTS, *observations.MEASURES)
    lines = ["|".join(names)] + ["|".join(["2022", "10", "1", *["1.5"] * 7, "T" if k == 3 else "2"]) for k in range(6)]
    (tmp_path / "2022.psv").write_text("\n".join(lines) + "\n")
    period, template, raw = Period.of("2022-10-01", "2022-10-31"), f"{tmp_path}/{{period}}.psv", str(tmp_path / "raw")
    path = observations.promote_observations(spark, template, raw, ["2022"], misfits="quarantine")
    assert observations.read_raw_observations(spark, raw, period, misfits="quarantine").count() == 5
    assert [r.reason for r in read_quarantined(spark, path).collect()] == [f"{observations.MEASURES[-1]} is no double"]


def test_a_task_sorts_one_split_of_volumes(spark, tmp_path):
    """A year's counts are not gathered into one task before they are written."""
    for k in range(3):
        lines = "".join(f"{v},2024,{m},5,Bronx\n" for v in range(50) for m in (1, 13))
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / f"{k}.csv").write_text("vol,yr,m,d,boro\n" + lines)
    splits = spark.read.csv(str(tmp_path / "landing"), header=True).rdd.getNumPartitions()
    path = volumes.promote_volumes(spark, str(tmp_path / "landing"), str(tmp_path / "raw"))
    for year in ("2024", "undated"):
        files = list(Path(path).glob(f"batch=*/period={year}/*.parquet"))
        assert len(files) == splits > 1
        assert spark.read.parquet(*map(str, files)).count() == 150


def test_landing_trips_move_what_the_feeds_are_made_of(spark, monkeypatch):
    """The tables' own columns are kept and gathered; the feed's wider ones are worked out afterwards."""
    seen = []
    monkeypatch.setattr(daily_tables, "clear_scratch", lambda spark, path: seen.append(spark.read.parquet(path)))
    landing = daily_tables.landing_trips(spark, "/root/testdata/sf0.001")
    assert set(seen[0].columns) == {*daily_tables.FED_COLUMNS, "period", "source"}
    feeds = [spark.read.parquet(f"{landing}/{spec.name}") for spec in (trips.YELLOW, trips.GREEN)]
    assert sum(f.count() for f in feeds) == seen[0].count() > 0
