"""Delimited text with a record of what does not fit.

``read_checked`` gives every line of the files once: typed, and with a reason if the line has another
number of fields than the header or a field's text does not fit its type. ``promote_checked`` writes
lines that fit and lines that do not in the same job, in folders apart, so each line is kept or
quarantined, and both show at the same moment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daymill.sources.manifest import promote_at_once, read_promoted
from daymill.sources.scans import PERIOD_COLUMN

#: What is known of a line that does not fit.
NOTES = {"reason": "string", "record": "string", "source_file": "string"}
_ACCEPTED = "accepted"
_BROKEN = "_broken_record"


def read_checked(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, str], separator: str = ",") -> DataFrame:
    """The named columns, typed, beside reason (null if the line fits), record and source_file.

    The header names the columns; files of one call must share it. Empty fields and blanks are nulls
    of any type. A broken line's record is its text, that of others their fields joined again.
    """
    header = spark.read.csv(path, header=True, sep=separator).columns
    schema = StructType([*(StructField(name, StringType()) for name in header), StructField(_BROKEN, StringType())])
    lines = (
        spark.read.schema(schema)
        .options(header=True, sep=separator, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, columnPruning=False)
        .csv(path)
    )
    broken = F.col(_BROKEN).isNotNull()
    reason = F.when(broken, "number of fields")
    for name, kind in types.items():
        text = F.trim(F.col(f"`{name}`"))
        reason = reason.when((text != "") & F.col(f"`{name}`").try_cast(kind).isNull(), f"{name} is no {kind}")
    fields = F.concat_ws(separator, *(F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in header))
    return lines.select(
        *(F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in types.items()),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.coalesce(_BROKEN, fields)).alias("record"),
        F.when(reason.isNotNull(), F.input_file_name()).alias("source_file"),
    )


def promote_checked(checked: DataFrame, raw_root: str, source: str, rebalance: bool = False, periods: Sequence[str] = ()) -> str:
    """Promote lines that fit and lines that do not, of ``read_checked`` with a period, in one job."""
    marked = checked.withColumn(_ACCEPTED, F.col("reason").isNull())
    return promote_at_once(marked, raw_root, source, rebalance, periods, within=[_ACCEPTED])


def read_accepted(spark: SparkSession, path: str, types: Mapping[str, str], periods: Sequence[str] | None = None) -> DataFrame:
    """The lines that fit; folders of others are not read."""
    return read_promoted(spark, path, {**types, _ACCEPTED: "boolean"}, periods).filter(_ACCEPTED).drop(_ACCEPTED, PERIOD_COLUMN)


def read_quarantined(spark: SparkSession, path: str, periods: Sequence[str] | None = None) -> DataFrame:
    """reason, record and source_file of the lines that do not fit."""
    return read_promoted(spark, path, {**NOTES, _ACCEPTED: "boolean"}, periods).filter(~F.col(_ACCEPTED)).drop(_ACCEPTED)
