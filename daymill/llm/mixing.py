"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source has a target in words and each of its documents the same expected number of copies,
target over size of the source. The documents of a source stand in the order of their sizes; the sum of the
expected copies up to a document, plus one random offset for the source, crosses so many whole numbers
at that document, and that is how often it is taken. As neighbours are about equally long, what a source gives
differs from its target by less than its longest document.

The sums need a document's place in its source, and a source may hold a third of all documents. So documents
are dealt by ranges of (source, size, doc_id), places are counted within each range, and a small
table of ranges has the documents before it. No window and no join is over a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill.llm.common import stage

WORDS = r"[^\x20\x09-\x0D]+"


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` dealt by ranges of ``order``, written, with the number of the range as ``slice``."""
    return stage(df.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "mix-ranges")


def places_of(names: DataFrame) -> DataFrame:
    """The rows of a table of distinct sources with their place from 0 on, by code point and null last."""
    ranges = in_ranges(names, F.col("source").asc_nulls_last())
    sizes = ranges.groupBy("slice").agg(F.count("*").alias("n"))
    before = sizes.select("slice", (F.sum("n").over(Window.orderBy("slice")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last()))
    return ranges.withColumn("within", within).join(before, "slice").withColumn("place", F.col("before") + F.col("within") - 1).drop("slice", "before", "within")


def targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: a share of all sizes by weight, at most ``most`` times the own size.

    Sources by code point, null last, have the weights in turn. What lies above a source's bound is shared again by
    weight until no source is above; each round adds up the sources over their bound, and only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stage(places_of(sources).withColumn("weight", weight).withColumn("bound", F.col("source_size") * most), "mix-sources")
    total, shares = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    left, open_ = total, shares

    def exact(value) -> Column:
        return (F.lit(value) if isinstance(value, int) else F.col(value)).cast("decimal(19,0)")

    while True:
        above = exact("bound") * exact(open_ or 0) < exact(left or 0) * exact("weight")
        bounds, taken = weighed.filter(above).agg(F.coalesce(F.sum("bound"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if ((total or 0) - bounds, (shares or 0) - taken) == (left or 0, open_ or 0):
            break
        left, open_ = total - bounds, shares - taken
    share = F.lit(float(left or 0)) * F.col("weight") / F.lit(float(open_ or 1))
    target = F.when(above, F.col("bound").cast("double")).otherwise(share)
    return weighed.select("source", "source_size", target.alias("target"))


def offset(seed: str) -> Column:
    """The random offset of a source, from 0 up to 1 in steps of 2**-32."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 256)
    return F.conv(F.substring(name, 1, 8), 16, 10).cast("double") / float(1 << 32)


def copies(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix", whole: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every document, and with ``whole`` its ``row``.

    Size is the number of words; a null text has none. A null source is a source. Sources without words
    have target 0 and give no copies. Documents of equal size stand by doc_id, null first; rows with the same doc_id
    keep the order of the files. Without documents the result is empty. Carrying the rows moves the texts along.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    carried = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    sized = stage(docs.select("doc_id", "source", size.alias("size"), F.monotonically_increasing_id().alias("at"), *carried), "mix-sizes")
    order = ("size", "doc_id", "at")
    ranges = in_ranges(sized, F.col("source").asc_nulls_last(), *order)
    parts = stage(ranges.groupBy("slice", "source").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-parts")
    aims = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    before = F.sum("n").over(Window.partitionBy("source").orderBy("slice")) - F.col("n")
    aimed = parts.withColumn("before", before).withColumnsRenamed({"source": "of", "slice": "part"})
    aimed = aimed.join(aims, F.col("of").eqNullSafe(F.col("source")), "left").select("part", "of", "before", "source_size", "target", offset(seed).alias("u"))
    within = F.row_number().over(Window.partitionBy("slice", "source").orderBy(*order))
    placed = ranges.withColumn("within", within).join(aimed, (F.col("slice") == F.col("part")) & F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("before") + F.col("within")
    crossed = F.floor(place * F.col("rate") + F.col("u")) - F.floor((place - 1) * F.col("rate") + F.col("u"))
    columns = ["doc_id", "source", "size", "source_size", "target", crossed.alias("copies")]
    return placed.withColumn("rate", rate).select(*columns, *(["row"] if whole else []))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """``row`` (all columns of a document) and ``copy`` (from 1 on), one row per copy in the mix."""
    taken = copies(docs, weights, most, seed, whole=True).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
