"""Scans of Parquet and delimited text, single or by period."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.conform import union_sources

PERIOD_COLUMN = "period"

LOOKUPS_AT_ONCE = 16


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    separator: str = ",",
) -> DataFrame:
    """Text with a header line, every column a string; with ``types`` the named columns only, typed.

    The header names the columns, so their order is free; files of one path whose
    header differs are an error instead of shifted columns. Text that does not fit
    its type turns null at once, so no later aggregate trips over it. Columns not
    asked for are skipped by the parser.
    """
    text = spark.read.csv(path, header=True, sep=separator, enforceSchema=False)
    if types is None:
        return text
    return text.select(*(F.col(name).try_cast(kind).alias(name) for name, kind in types.items()))


def period_paths(template: str, periods: Sequence[str]) -> dict[str, str]:
    """``{"2022-10": ".../2022-10.parquet"}`` from ``.../{period}.parquet``."""
    return {period: template.format(period=period) for period in periods}


def scan_period(
    spark: SparkSession,
    template: str,
    periods: Sequence[str],
    conform: Callable[[DataFrame], DataFrame],
    stamp: str | None = None,
    missing: str = "error",
) -> DataFrame:
    """The Parquet files of the given months or years as one conformed frame.

    Names and types drift between the files of a feed, so each file's own schema is
    looked up. Files that agree become one scan, so the plan grows with the number of
    layouts and not of files. ``stamp`` names a column to hold the period of a row's
    file, taken from the file's path. With ``missing="skip"`` periods without a file are
    left out, as long as one has a file.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be 'error' or 'skip', not {missing!r}")
    paths = period_paths(template, periods)

    def look_up(path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if missing == "skip" and error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    with ThreadPoolExecutor(max_workers=LOOKUPS_AT_ONCE) as lookups:
        found = dict(zip(paths, lookups.map(look_up, paths.values()), strict=True))
    frames = {period: frame for period, frame in found.items() if frame is not None}
    if not frames:
        raise FileNotFoundError(f"no file of {template} for {', '.join(periods)}")
    layouts: dict[str, list[str]] = {}
    for period, frame in frames.items():
        layouts.setdefault(frame.schema.json(), []).append(period)
    scans = (
        conform(
            spark.read.schema(frames[alike[0]].schema).parquet(*(paths[period] for period in alike))
        )
        for alike in layouts.values()
    )
    if stamp:
        scans = (scan.withColumn(stamp, _period_of_file(template)) for scan in scans)
    return union_sources(scans)


def _period_of_file(template: str) -> Column:
    """What stands for ``{period}`` in the path of a row's file."""
    folder = next(part for part in template.split("/") if "{period}" in part)
    before, after = map(re.escape, folder.split("{period}", 1))
    return F.regexp_extract(F.input_file_name(), f"/{before}([^/]*?){after}(?:/|$)", 1)


def scan_text_period(
    spark: SparkSession,
    template: str,
    periods: Sequence[str],
    types: Mapping[str, str],
    separator: str = ",",
    stamp: str | None = None,
) -> DataFrame:
    """The delimited files of the given months or years, each by its own header."""
    frames = []
    for period, path in period_paths(template, periods).items():
        frame = read_delimited(spark, path, types, separator)
        frames.append(frame.withColumn(stamp, F.lit(period)) if stamp else frame)
    return union_sources(frames)
