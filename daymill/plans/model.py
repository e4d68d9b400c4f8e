"""Feature table of the daily tables, and a linear regression on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import ratio
from daymill.operators.daily import join_back
from daymill.operators.rules import filter_dates
from daymill.period import Period
from daymill.sources import read_parquet, write_table


def feature_table(
    zone_days: DataFrame,
    zones: DataFrame,
    volumes: DataFrame,
    observations: DataFrame,
    zone: str = "pu_location_id",
    borough: str = "boro",
    date: str = "date",
) -> DataFrame:
    """Zone-days with their borough's volume and the day's observations; gaps stay null.

    ``zones`` maps zone to borough, one row per zone. Spark picks each join by the
    measured size of its smaller side; a lookup or daily table below the broadcast
    threshold costs no shuffle, a larger one still works.
    """
    located = join_back(zone_days, zones.select(zone, borough), [zone])
    return join_back(join_back(located, volumes, [borough, date]), observations, [date])


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Least squares over the rows that have the label and every feature."""
    steps = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
        LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction"),
    ]
    return Pipeline(stages=steps).fit(df.dropna(subset=[label]).select(*features, label))


def build_model(
    spark: SparkSession,
    curated: Mapping[str, str],
    zones: DataFrame,
    out_root: str,
    features: Sequence[str],
    label: str,
    training: Period,
    scored: Period,
    **names: str,
) -> dict[str, str]:
    """Curated daily tables → feature table → regression; returns the paths written.

    ``curated`` has the paths ``zone_days``, ``volumes`` and ``observations``. The model is
    fit on the training period and applied to the other; ``features``, ``coefficients``,
    ``scored`` and ``quality`` are written below ``out_root``. Zone-days without a feature
    stay, with a null prediction.
    """
    tables = (read_parquet(spark, curated[name]) for name in ("zone_days", "volumes", "observations"))
    zone_days, volumes, observations = tables
    paths = {name: f"{out_root}/{name}" for name in ("features", "coefficients", "scored", "quality")}
    joined = feature_table(zone_days, zones, volumes, observations, **names)
    write_table(joined, paths["features"])
    stored = read_parquet(spark, paths["features"])
    date = names.get("date", "date")
    model = fit_linear(filter_dates(stored, date, training), features, label)
    write_table(coefficients(spark, model, features), paths["coefficients"])
    write_table(score(model, filter_dates(stored, date, scored)), paths["scored"])
    write_table(evaluate(read_parquet(spark, paths["scored"]), label), paths["quality"])
    return paths


def coefficients(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``term, value``: the intercept and one row per feature."""
    line = model.stages[-1]
    rows = [("intercept", float(line.intercept))]
    rows += [(name, float(value)) for name, value in zip(features, line.coefficients, strict=True)]
    return spark.createDataFrame(rows, "term string, value double")


def score(model: PipelineModel, df: DataFrame, drop_unscored: bool = False) -> DataFrame:
    """All rows with a ``prediction``, null where a feature is missing; or only the others."""
    assembler, line = model.stages
    features = assembler.getInputCols()
    terms = zip(features, line.coefficients, strict=True)
    prediction = F.lit(float(line.intercept))
    for name, value in terms:
        prediction = prediction + F.col(name) * F.lit(float(value))
    scored = df.withColumn("prediction", prediction)
    return scored.dropna(subset=list(features)) if drop_unscored else scored


def evaluate(scored: DataFrame, label: str) -> DataFrame:
    """Row count, rmse, mae and r2 of rows with label and prediction, from one aggregate."""
    error = F.col(label) - F.col("prediction")
    return (
        scored.dropna(subset=[label, "prediction"])
        .agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.var_pop(label).alias("variance"),
        )
        .select("num_rows", "rmse", "mae", (1 - ratio("mse", "variance")).alias("r2"))
    )
