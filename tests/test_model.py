import datetime as dt

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from daymill.plans.model import coefficients, evaluate, feature_table, fit_linear, score


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(11)
    a, b = draw.normal(size=200), draw.normal(size=200)
    y = 3 + 2 * a - 5 * b + draw.normal(scale=0.1, size=200)
    rows = list(zip(a.tolist(), b.tolist(), y.tolist(), strict=True))
    rows += [(None, 1.0, 2.0), (1.0, 1.0, None)]
    return spark.createDataFrame(rows, "a double, b double, y double"), np.column_stack([a, b]), y


def test_fit_is_least_squares_over_complete_rows(spark, sample):
    df, x, y = sample
    model = fit_linear(df, ["a", "b"], "y")
    found = {r["term"]: r["value"] for r in coefficients(spark, model, ["a", "b"]).collect()}
    exact, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)
    assert list(found) == ["intercept", "a", "b"]
    assert list(found.values()) == pytest.approx(exact.tolist())


def test_evaluation_agrees_with_spark_ml(sample):
    df, *_ = sample
    scored = score(fit_linear(df, ["a", "b"], "y"), df)
    assert "features" not in scored.columns and scored.count() == 202
    found = evaluate(scored, "y").first()
    assert found["num_rows"] == 200
    known = scored.dropna(subset=["y", "prediction"])
    for metric in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", metricName=metric)
        assert found[metric] == pytest.approx(evaluator.evaluate(known))


def test_feature_table_keeps_every_zone_day(spark):
    one, two = dt.date(2022, 10, 1), dt.date(2022, 10, 2)
    zone_days = spark.createDataFrame(
        [(1, one, 5.0), (2, two, 6.0), (9, one, 7.0)], "pu_location_id long, date date, fare double"
    )
    zones = spark.createDataFrame([(1, "Bronx", 0), (2, "Queens", 0)], "pu_location_id long, boro string, x int")
    volumes = spark.createDataFrame([("Bronx", one, 70.0)], "boro string, date date, total_vol double")
    days = spark.createDataFrame([(one, 15.0)], "date date, mean_temperature double")
    found = {r["pu_location_id"]: r for r in feature_table(zone_days, zones, volumes, days).collect()}
    assert (found[1]["boro"], found[1]["total_vol"], found[1]["mean_temperature"]) == ("Bronx", 70.0, 15.0)
    assert (found[2]["boro"], found[2]["total_vol"], found[2]["mean_temperature"]) == ("Queens", None, None)
    assert (found[9]["boro"], found[9]["total_vol"], found[9]["mean_temperature"]) == (None, None, 15.0)


def test_rows_without_a_feature_stay_unscored(spark, sample):
    model = fit_linear(sample[0], ["a", "b"], "y")
    rows = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None)], "id int, a double, b double")
    scored = {r["id"]: r["prediction"] for r in score(model, rows).collect()}
    assert scored[1] is not None and scored[2] is None and scored[3] is None
    assert score(model, rows, drop_unscored=True).count() == 1
