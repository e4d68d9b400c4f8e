"""Parquet tables of the raw and curated layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymill.sources.scans import PERIOD_COLUMN


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def promote(
    df: DataFrame,
    raw_root: str,
    source: str,
    rebalance: bool = False,
    periods: Sequence[str] = (),
) -> str:
    """Write a source's conformed rows to its own raw path, one folder per period.

    One job writes all periods. Periods not in ``df`` stay as they are, so a later
    month can be added by itself; those named in ``periods`` are emptied if ``df`` has
    no row of theirs, so a corrected file without rows leaves no old ones behind. Rows
    read file by file are already apart by period; for rows in mixed order ``rebalance``
    gathers each period first, where adaptive execution splits crowded periods and
    merges thin ones.
    """
    path = f"{raw_root.rstrip('/')}/{source}"
    seen = Observation()  # which periods there are comes with the write
    rows = df.hint("rebalance", F.col(PERIOD_COLUMN)) if rebalance else df
    if periods:
        rows = rows.observe(seen, F.collect_set(PERIOD_COLUMN).alias("periods"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PERIOD_COLUMN)
        .parquet(path)
    )
    if periods:
        brought = set(seen.get.get("periods") or ())
        nothing = df.drop(PERIOD_COLUMN).limit(0)
        for period in sorted(set(periods) - brought):
            write_table(nothing, f"{path}/{PERIOD_COLUMN}={period}")
    return path


def read_layer(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """A promoted source without its period column; only the folders of ``periods`` are read.

    The types are declared, so no footer is read for them and ``2022-10`` stays text.
    """
    columns = {n: kind for n, kind in types.items() if n != PERIOD_COLUMN}
    columns[PERIOD_COLUMN] = "string"
    table = spark.read.schema(", ".join(f"{n} {kind}" for n, kind in columns.items())).parquet(path)
    if periods is not None:
        table = table.filter(F.col(PERIOD_COLUMN).isin(list(periods)))
    return table.drop(PERIOD_COLUMN)
