"""A corpus pipeline: from documents to packed training sequences, one operator per stage.

Every stage takes what its predecessor kept, is written as Parquet to the shared folder and
read back, so a lost executor repeats a part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import decontaminate, line_dedup, packing, simhash_groups, subword
from daymill.llm.common import stage
from daymill.llm.queries import byte_bpe, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier, learned from all labels, does not reject."""
    scored = subword.classify(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds; n_chars counts what stays."""
    kept = line_dedup.dedup(docs)
    replaced = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(replaced.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group: four-word shingles, at most 4 differing bits."""
    return simhash_groups.keep_one(docs, shingle=4, radius=4)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its place in a training sequence."""
    return packing.pack_documents(docs, byte_bpe(), capacity=1024, end_id=2)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]

#: A learned classifier and a search for the fewest sequences are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
