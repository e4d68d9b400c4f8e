"""Small helpers shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.session import scratch_path

#: White space that separates words everywhere here: blank and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that nothing above is run twice."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """The two columns operators read, a null text as an empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def binary_rows(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its texts as UTF-8 bytes."""
    for batch in batches:
        texts_ = batch.column(batch.schema.get_field_index(column))
        yield batch, [t or b"" for t in texts_.cast(pa.large_binary()).to_pylist()]


def batch_of(batch: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    """Columns ``keep`` of a batch beside new ones."""
    arrays = {name: batch.column(batch.schema.get_field_index(name)) for name in keep}
    return pa.RecordBatch.from_pydict(arrays | columns)


def fold_of(column: str, folds: int):
    """The fold of a row: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected edges (a, b): node, label (its smallest reachable node).

    Alternating star contraction: every round hangs each node's neighbours on the smallest
    of them, first the larger neighbours, then the smaller ones, until nothing moves. Rounds
    grow with the logarithm of the longest path; each one is a written table, so a lost
    executor repeats a part of one round only. Self links and repeated links are allowed; an
    empty table gives an empty one.
    """
    now = stage(_toward_smaller(edges.select("a", "b")), label)
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        now = stage(_small_star(_large_star(now)), label)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _toward_smaller(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _toward_smaller(moved)


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _toward_smaller(moved.union(least))


def shards_for(rows: int, per_shard: int) -> int:
    """Number of shards that hold about ``per_shard`` rows each."""
    return max(1, math.ceil(rows / per_shard))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns, with the end as last entry."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
