"""Curated tables laid out for reading by two keys, and tables that join without a shuffle.

``write_interleaved`` sorts by a code in which the bits of two keys' places alternate, so rows that
are near in both keys lie in the same files. Ranges of the code are taken from a sample of it, and
only rows within a file are sorted. A filter on either key, or on both, then skips most files by
their statistics.

``write_bucketed`` writes tables in buckets of the same keys; two of them join bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of each key's place in the code.
PLACE_BITS = 12
#: Quantiles that cut a key into places of about equal numbers of rows.
CUTS = 255


def _place(name: str, cuts: Sequence) -> Column:
    """How many of the cuts are at or below a value; null is before all."""
    column = F.col(name)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= column)), F.lit(0)) if cuts else F.lit(0)


def _interleaved(first: Column, second: Column) -> Column:
    """A number whose bits are those of the two places in turn."""
    code = F.lit(0).cast("long")
    for bit in range(PLACE_BITS):
        for k, place in enumerate((second, first)):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), 2 * bit + k))
    return code


def key_cuts(df: DataFrame, name: str) -> list:
    """Values that cut a numeric or date key into about equal parts, from one aggregate."""
    kind = dict(df.dtypes)[name]
    number = F.unix_date(name) if kind == "date" else F.col(name)
    cuts = df.agg(F.percentile_approx(number, [k / (CUTS + 1) for k in range(1, CUTS + 1)], 10_000)).first()[0] or []
    return sorted(set(cuts))


def write_interleaved(df: DataFrame, path: str, first: str, second: str, files: int, replace: bool = True) -> None:
    """Write ``df`` to about ``files`` files, near rows by two numeric or date keys together, sorted by both within a file.

    No total sort: ranges of the code come from a sample, and the files in their order hold rising codes.
    """
    kinds = dict(df.dtypes)
    places = []
    for name in (first, second):
        number = f"_number_{name}"
        df = df.withColumn(number, F.unix_date(name) if kinds[name] == "date" else F.col(name))
        places.append(_place(number, key_cuts(df, number)))
    code = _interleaved(*places)
    numbers = [f"_number_{name}" for name in (first, second)]
    ranged = df.withColumn("_code", code).repartitionByRange(files, "_code", *numbers).sortWithinPartitions(*numbers)
    ranged.drop("_code", *numbers).write.mode("overwrite" if replace else "append").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Save ``df`` below ``path`` as a table of the session's catalog, in buckets by the keys and sorted by them within each."""
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def join_bucketed(spark: SparkSession, left: str, right: str, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Two tables of ``write_bucketed`` with the same keys and number of buckets, joined without moving a row."""
    return spark.table(left).hint("merge").join(spark.table(right), list(keys), how)
