"""Counts along the way, layers that change at once, quantiles, quarantine and kept trim state."""

import math
import random
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from daymill.operators import quantiles
from daymill.operators.outliers import outlier_bounds
from daymill.operators.quantiles import exact_quantiles, five_numbers, merged_quantiles, rank_errors, sketches
from daymill.operators.rules import Rule
from daymill.operators.steps import Step, apply_steps, rule_steps, step_report
from daymill.operators.trim_state import keep_moments, merged_moments, state_bounds, trim_from_state
from daymill.sources import manifest, promote, write_table
from daymill.sources.manifest import current, promote_at_once, read_promoted, sweep
from daymill.sources.quarantine import promote_checked, read_accepted, read_checked, read_quarantined

TYPES = {"item": "long", "fee": "double"}


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


# --- counts ----------------------------------------------------------------------------


def test_steps_are_counted_by_the_write(spark, tmp_path):
    rows = [(1, 5.0), (2, None), (3, -1.0), (4, 99.0), (None, -3.0), (None, None), (6, 7.0)]
    df = spark.createDataFrame(rows, "a int, b double")
    steps = [*rule_steps([Rule("b", ">=", 0), Rule("b", "<=", 10)]), Step("has a", F.col("a").isNotNull())]
    counts = Observation()
    write_table(apply_steps(df, steps, counts), str(tmp_path / "t"))
    report = [tuple(r) for r in step_report(spark, steps, counts).orderBy("position").collect()]
    assert report == [(0, "input", 0, 0, 7), (1, "b >= 0", 4, 4, 3), (2, "b <= 10", 3, 1, 2), (3, "has a", 2, 0, 2)]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_counting_runs_no_job_of_its_own(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select(F.col("id").cast("double").alias("b"))
    steps, counts = rule_steps([Rule("b", ">", 10)]), Observation()
    plain = jobs_of(spark, "plain-write", lambda: write_table(apply_steps(df, steps), str(tmp_path / "a")))

    def counted():
        write_table(apply_steps(df, steps, counts), str(tmp_path / "b"))
        step_report(spark, steps, counts)

    assert jobs_of(spark, "counted-write", counted) == plain


def test_steps_of_an_empty_table(spark, tmp_path):
    steps, counts = rule_steps([Rule("b", ">", 10)]), Observation()
    write_table(apply_steps(spark.createDataFrame([], "b double"), steps, counts), str(tmp_path / "t"))
    assert [r.num_left for r in step_report(spark, steps, counts).collect()] == [0, 0]


# --- layers ----------------------------------------------------------------------------


def stamped(spark, fee, *months):
    return spark.createDataFrame([(i, fee, m) for m in months for i in range(4)], "item long, fee double, period string")


def fees(spark, path, periods=None):
    return sorted(r.fee for r in read_promoted(spark, path, TYPES, periods).collect())


def test_promotion_replaces_empties_and_keeps(spark, tmp_path):
    root = str(tmp_path / "raw")
    path = promote_at_once(stamped(spark, 1.0, "2022-10", "2022-11", "2022-12"), root, "a")
    promote_at_once(stamped(spark, 2.0, "2022-11"), root, "a", periods=["2022-11", "2022-12", "2023-01"])
    assert fees(spark, path) == [1.0] * 4 + [2.0] * 4
    assert fees(spark, path, ["2022-12"]) == [] and fees(spark, path, ["2022-11"]) == [2.0] * 4
    assert read_promoted(spark, path, TYPES).columns == ["item", "fee"]
    assert read_promoted(spark, str(tmp_path / "none"), TYPES).collect() == []


def test_a_promotion_that_dies_leaves_the_old_layer(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    path = promote_at_once(stamped(spark, 1.0, "2022-10", "2022-11"), root, "a")
    broken = stamped(spark, 2.0, "2022-10").withColumn("fee", F.when(F.col("item") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("fee")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        promote_at_once(broken, root, "a", periods=["2022-10", "2022-11"])
    assert fees(spark, path) == [1.0] * 8

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(manifest, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            promote_at_once(stamped(spark, 2.0, "2022-10"), root, "a", periods=["2022-10", "2022-11"])
    with monkeypatch.context() as patched:
        patched.setattr(manifest._Folder, "rename", killed)
        with pytest.raises(KeyboardInterrupt):
            promote_at_once(stamped(spark, 3.0, "2022-10"), root, "a")
    assert fees(spark, path) == [1.0] * 8
    promote_at_once(stamped(spark, 4.0, "2022-10"), root, "a", periods=["2022-10", "2022-11"])
    assert fees(spark, path) == [4.0] * 4
    assert len(sweep(spark, path)) >= 3
    assert fees(spark, path) == [4.0] * 4


def test_readers_that_began_before_go_on(spark, tmp_path):
    root = str(tmp_path / "raw")
    path = promote_at_once(stamped(spark, 1.0, "2022-10"), root, "a")
    before = read_promoted(spark, path, TYPES)
    promote_at_once(stamped(spark, 2.0, "2022-10"), root, "a")
    assert [r.fee for r in before.collect()] == [1.0] * 4 and fees(spark, path) == [2.0] * 4


def test_of_two_promotions_at_once_one_fails(spark, tmp_path):
    root = str(tmp_path / "raw")
    path = promote_at_once(stamped(spark, 1.0, "2022-10"), root, "a")
    folder = manifest._Folder(spark, path)
    with pytest.raises(RuntimeError, match="promote again"):
        manifest._publish(folder, 1, {})
    assert fees(spark, path) == [1.0] * 4


def test_the_plan_runs_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            runs.add(len(frame))
            yield frame

    rows = stamped(spark, 1.0, "2022-10", "2022-11")
    for promotion, root in ((promote_at_once, "a"), (promote, "b")):
        before = runs.value
        promotion(rows.mapInPandas(count, rows.schema), str(tmp_path / root), "s", periods=["2022-10", "2022-11", "2022-12"])
        assert runs.value - before == 8


def test_manifest_names_only_folders_below_the_layer(spark, tmp_path):
    path = promote_at_once(stamped(spark, 1.0, "2022-10"), str(tmp_path / "raw"), "a")
    for at in current(spark, path).values():
        assert at.startswith("batch=") and (Path(path) / at).is_dir()


# --- quantiles -------------------------------------------------------------------------


def plain_quantile(values, p):
    values = sorted(values)
    place = (len(values) - 1) * p
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FETCHED", 20)
    rng = random.Random(1)
    columns = {
        "spread": [math.exp(rng.gauss(0, 30)) * rng.choice((-1, 1)) for _ in range(3000)],
        "tied": [rng.choice((0.0, 0.0, 0.0, 1.0, 2.0)) if rng.random() < 0.9 else rng.random() for _ in range(3000)],
        "two": [float(i % 2) for i in range(3000)],
        "same": [7.5] * 3000,
    }
    rows = [(*r, None if i else 4.0, None, float("nan")) for i, r in enumerate(zip(*columns.values(), strict=True))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in (*columns, "one", "none", "nan"))).repartition(5)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    found = exact_quantiles(df, df.columns, probabilities)
    for name, values in columns.items():
        assert found[name] == pytest.approx([plain_quantile(values, p) for p in probabilities], rel=1e-12, abs=0)
    assert found["one"] == [4.0] * 7 and found["none"] == found["nan"] == [None] * 7


def test_five_numbers_of_no_rows(spark):
    assert [tuple(r) for r in five_numbers(spark.createDataFrame([], "a int"), ["a"]).collect()] == [("a", None, None, None, None, None)]


def test_a_later_period_adds_its_sketch(spark, tmp_path):
    def month(name, low):
        return spark.range(low, low + 5000).select((F.col("id") * 1.5).alias("x"), F.lit(None).cast("double").alias("y"), F.lit(name).alias("period"))

    root, kinds = str(tmp_path), {"column_name": "string", "sketch": "binary"}
    path = promote_at_once(sketches(month("2022-10", 0), ["x", "y"], "period"), root, "s")
    promote_at_once(sketches(month("2022-11", 5000), ["x", "y"], "period"), root, "s")
    found = merged_quantiles(read_promoted(spark, path, kinds), (0.1, 0.5)).collect()
    assert {(r.column_name, r.num_values) for r in found} == {("x", 10_000)}
    everything = month("", 0).union(month("", 5000))
    errors = rank_errors(everything, {"x": {r.probability: r.value for r in found}})
    assert all(error <= 0.02 for error in errors.values()) and len(errors) == 2
    one = merged_quantiles(read_promoted(spark, path, kinds, ["2022-10"]), (1.0,)).first()
    assert one.value == 4999 * 1.5


# --- quarantine ------------------------------------------------------------------------


def test_lines_are_kept_or_quarantined(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.psv").write_text("id|day|x|note\n1|2022-10-01|1.5|a\n2|2022-10-02|T|b\n3|2022-13-01|2|c\n4||  |d\n5|2022-10-01\n6|2022-10-01|3|e|more\n")
    (tmp_path / "in" / "2.psv").write_text("id|day|x|note\nseven|2022-10-01|4|f\n8|2022-10-01|5|g\n")
    types = {"id": "long", "day": "date", "x": "double"}
    checked = read_checked(spark, str(tmp_path / "in"), types, "|")
    path = promote_checked(checked.withColumn("period", F.lit("2022")), str(tmp_path / "raw"), "s", periods=["2022"])
    kept, odd = read_accepted(spark, path, types), read_quarantined(spark, path).collect()
    assert kept.columns == ["id", "day", "x"]
    assert sorted((r.id, r.x) for r in kept.collect()) == [(1, 1.5), (4, None), (8, 5.0)]
    assert sorted((r.reason, r.record) for r in odd) == [
        ("day is no date", "3|2022-13-01|2|c"),
        ("id is no long", "seven|2022-10-01|4|f"),
        ("number of fields", "5|2022-10-01"),
        ("number of fields", "6|2022-10-01|3|e|more"),
        ("x is no double", "2|2022-10-02|T|b"),
    ]
    assert {r.source_file.rsplit("/", 1)[1] for r in odd if r.record.startswith("seven")} == {"2.psv"}
    assert kept.count() + len(odd) == 8


def test_keeping_and_quarantining_is_one_pass(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n2,T\n")
    checked = read_checked(spark, str(tmp_path / "a.csv"), {"id": "int", "x": "double"}).withColumn("period", F.lit("p"))
    assert jobs_of(spark, "quarantine", lambda: promote_checked(checked, str(tmp_path / "raw"), "s")) == 1


# --- trim state ------------------------------------------------------------------------


def readings(spark, months, seed=3):
    rng = random.Random(seed)
    rows = [(m, rng.gauss(10, 2) if rng.random() < 0.95 else None, rng.choice((1.0, 500.0, float("nan")))) for m in months for _ in range(400)]
    return spark.createDataFrame(rows, "period string, a double, b double")


def test_bounds_from_kept_moments(spark, tmp_path):
    months = ["2022-10", "2022-11", "2022-12"]
    rows = readings(spark, months)
    for month in months:
        path = keep_moments(rows.filter(F.col("period") == month), str(tmp_path), "r", ["a", "b"])
    want = outlier_bounds(rows, ["a", "b"], "single_pass")
    for found, bound in zip(state_bounds(spark, path, ["a", "b"]), want, strict=True):
        assert (found.column, found.low, found.high) == (bound.column, pytest.approx(bound.low), pytest.approx(bound.high))
    kept = trim_from_state(rows, path, ["a", "b"])
    assert kept.count() == rows.filter(want[0].condition() & want[1].condition()).count()
    some = state_bounds(spark, path, ["a"], ["2022-11"])[0]
    alone = outlier_bounds(rows.filter("period = '2022-11'"), ["a"], "single_pass")[0]
    assert (some.low, some.high) == (pytest.approx(alone.low), pytest.approx(alone.high))
    with pytest.raises(ValueError, match="no moments"):
        state_bounds(spark, path, ["c"])


def test_only_the_new_month_is_scanned(spark, tmp_path):
    """Old months' rows are gone, and their moments still count."""
    months = ["2022-10", "2022-11"]
    rows = readings(spark, months)
    want = outlier_bounds(rows, ["a"], "single_pass")[0]
    raw = promote_at_once(rows, str(tmp_path / "raw"), "r")
    for month in months:
        read = read_promoted(spark, raw, {"a": "double", "b": "double"}, [month])
        assert all(f"period={month}" in file for file in read.inputFiles())
        path = keep_moments(read.withColumn("period", F.lit(month)), str(tmp_path / "state"), "r", ["a"])
        for file in read.inputFiles():
            Path(file.removeprefix("file://")).unlink()
    bound = state_bounds(spark, path, ["a"])[0]
    assert (bound.low, bound.high) == (pytest.approx(want.low), pytest.approx(want.high))
    assert merged_moments(spark, path)["a"].rows == 800
