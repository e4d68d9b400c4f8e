"""Exact ranks and rank correlations, ridge from Gram matrices, sorted and bucketed tables."""

import math
import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymill.operators import ranks
from daymill.operators.ranks import rank_correlations, value_ranks
from daymill.plans.ridge import best_strength, cross_validated_ridge, fit_ridge, fold_grams, time_fold
from daymill.sources.sorted_sink import join_bucketed, write_bucketed, write_interleaved


def plain_ranks(values):
    order = sorted(values)
    return {v: (order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in set(values)}


def plain_correlation(pairs):
    xs, ys = zip(*pairs, strict=True)
    rx, ry = plain_ranks(xs), plain_ranks(ys)
    a, b = np.array([rx[x] for x in xs]), np.array([ry[y] for y in ys])
    return float(np.corrcoef(a, b)[0, 1])


def hot_rows():
    """A third of all rows have one value."""
    rng = random.Random(4)
    rows = []
    for k in range(900):
        x = 5.0 if k % 3 == 0 else rng.gauss(0, 9)
        rows.append((x, rng.randint(0, 4), x * x + rng.random(), None if k % 7 == 0 else x - rng.random(), 1.0, float("nan")))
    return rows


SCHEMA = "a double, b int, c double, d double, same double, odd double"


def test_value_ranks_with_ties(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(r.column_name, r.value): r["rank"] for r in value_ranks(df, ["a", "b", "d", "odd"]).collect()}
    want = {}
    for k, name in ((0, "a"), (1, "b"), (3, "d")):
        want |= {(name, float(v)): rank for v, rank in plain_ranks([r[k] for r in rows if r[k] is not None]).items()}
    assert got == want


def test_rank_correlations(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.column_name: r.rank_correlation for r in rank_correlations(df, "a", ["b", "c", "d", "same", "odd"]).collect()}
    assert got.keys() == {"b", "c", "d", "same"} and got["same"] is None
    for name, k in (("b", 1), ("c", 2), ("d", 3)):
        assert got[name] == pytest.approx(plain_correlation([(r[0], r[k]) for r in rows if r[k] is not None]), abs=1e-12)


def test_no_table_of_pairs_of_values(spark, monkeypatch):
    """What is moved and kept grows with the values of a column, not with the pairs they form with the target's."""
    kept = []
    real = ranks._stored
    monkeypatch.setattr(ranks, "_stored", lambda df, label: kept.append(real(df, label)) or kept[-1])
    rows = [(float(k % 25), float(k % 40)) for k in range(1000)]
    got = rank_correlations(spark.createDataFrame(rows, "y double, x double"), "y", ["x", "x"]).collect()
    assert [(r.column_name, r.rank_correlation) for r in got] == [("x", pytest.approx(plain_correlation(rows), abs=1e-12))]
    assert max(df.count() for df in kept) == 40


def test_ranks_of_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert value_ranks(empty, ["a"]).collect() == [] and rank_correlations(empty, "a", ["b"]).collect() == []


# --- ridge -----------------------------------------------------------------------------


def days(n=400):
    rng = np.random.default_rng(1)
    x = rng.normal(1000, 3, (n, 2))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 1, n)
    return [(date(2022, 1, 1) + timedelta(int(k)), float(a), float(b), 7.0, float(c)) for k, ((a, b), c) in enumerate(zip(x, y, strict=True))]


def test_ridge_is_that_of_the_rows_themselves(spark):
    rows = days()
    df = spark.createDataFrame([*rows, (date(2022, 1, 1), None, 1.0, 7.0, 1.0)], "date date, x1 double, x2 double, same double, y double").repartition(4)
    fold = time_fold("date", 10, 4)
    judged = {(r.strength, r.fold): (r.num_rows, r.rmse) for r in cross_validated_ridge(df, ["x1", "x2", "same"], "y", fold, [0.0, 0.1, 10.0]).collect()}
    of = np.array([(r[0].toordinal() - date(1970, 1, 1).toordinal()) // 10 % 4 for r in rows])
    x, y = np.array([r[1:3] for r in rows]), np.array([r[4] for r in rows])
    for strength in (0.0, 0.1, 10.0):
        for k in range(4):
            train, test = of != k, of == k
            mean, deviation = x[train].mean(0), x[train].std(0)
            z = (x[train] - mean) / deviation
            w = np.linalg.solve(z.T @ z + strength * train.sum() * np.eye(2), z.T @ (y[train] - y[train].mean()))
            p = (x[test] - mean) / deviation @ w + y[train].mean()
            assert judged[strength, k] == (test.sum(), pytest.approx(math.sqrt(((p - y[test]) ** 2).mean()), rel=1e-6))
    assert best_strength(cross_validated_ridge(df, ["x1", "x2"], "y", fold, [0.0, 10.0])) == 0.0


def test_ridge_of_nothing(spark):
    empty = spark.createDataFrame([], "date date, x double, y double")
    assert cross_validated_ridge(empty, ["x"], "y", time_fold("date", 7, 3), [0.1]).collect() == []
    one = spark.createDataFrame([(date(2022, 1, 1), 1.0, 2.0)], empty.schema)
    grams, centres = fold_grams(one, ["x"], "y", F.lit(0))
    assert fit_ridge(grams[0], 0.1).tolist() == [0.0, 0.0] and centres.tolist() == [1.0, 2.0]


# --- sinks -----------------------------------------------------------------------------


def test_interleaved_files_are_skipped(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.pmod(F.xxhash64("id"), F.lit(100)).alias("zone"), F.expr("date_add(DATE'2022-01-01', int(pmod(hash(id), 300)))").alias("date"), F.col("id").alias("n")
    )
    path = str(tmp_path / "t")
    write_interleaved(rows, path, "zone", "date", 64)
    back = spark.read.parquet(path)
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and back.count() == 40_000
    bounds = back.groupBy(F.input_file_name().alias("f")).agg(*(g(c).alias(f"{n}_{c}") for c in ("zone", "date") for n, g in (("low", F.min), ("high", F.max)))).collect()
    assert 40 <= len(bounds) <= 64
    zone, day = 31, date(2022, 5, 5)
    by_zone = [b for b in bounds if b.low_zone <= zone <= b.high_zone]
    by_day = [b for b in bounds if b.low_date <= day <= b.high_date]
    both = [b for b in by_zone if b.low_date <= day <= b.high_date]
    assert len(by_zone) <= len(bounds) // 3 and len(by_day) <= len(bounds) // 3 and len(both) <= 6
    in_order = back.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), "zone", "date").collect()
    files = {}
    for r in sorted(in_order, key=lambda r: r["at"]):
        files.setdefault(r.f, []).append((r.zone, r.date))
    assert all(f == sorted(f) for f in files.values())


def test_interleaved_nulls_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(None, None, 1), (1, date(2022, 1, 1), 2), (None, date(2022, 1, 2), 3)], "zone long, date date, n int")
    write_interleaved(rows, str(tmp_path / "a"), "zone", "date", 4)
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "a")).collect()) == [1, 2, 3]
    write_interleaved(rows.limit(0), str(tmp_path / "b"), "zone", "date", 4)
    assert spark.read.parquet(str(tmp_path / "b")).collect() == []


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    left = spark.range(500).select((F.col("id") % 20).alias("zone"), F.expr("date_add(DATE'2022-01-01', int(id / 20))").alias("date"), F.col("id").alias("n"))
    right = left.filter("n % 3 = 0").select("zone", "date", (F.col("n") * 2).alias("m"))
    try:
        write_bucketed(left, "left_days", str(tmp_path / "l"), ["zone", "date"], 6)
        write_bucketed(right, "right_days", str(tmp_path / "r"), ["zone", "date"], 6)
        joined = join_bucketed(spark, "left_days", "right_days", ["zone", "date"])
        assert sorted((r.n, r.m) for r in joined.collect()) == [(n, 2 * n if n % 3 == 0 else None) for n in range(500)]
        assert not re.search(r"\bExchange\b", joined._jdf.queryExecution().executedPlan().toString())
    finally:
        for name in ("left_days", "right_days"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
