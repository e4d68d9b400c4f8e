"""Lloyd's clustering of whole-number vectors with heap-ordered bounds.

A vector's gap is its distance to the second nearest centroid less that to its own. While the
centroids' moves since the last exact look, its own one's and the largest other one's, add up to
less than the gap, the vector cannot change cluster. So every cluster has a heap of gaps, keyed by
the gap plus the cluster's accumulated drift at the time of the look, and only entries whose key the
drift has reached are popped, compared with all centroids again and pushed anew.

The heap is a set of Parquet tables, one per round, each sorted by cluster and key within its
files: popping a round is a filter `cluster = c AND key <= drift of c`, which skips the parts of
the files that are not due. Pushing writes one new table of what was popped. Nothing is deleted:
drift only grows, so an entry is out of the heap once the drift of an earlier round had reached it.
Vectors never move between tasks; centroids follow from the sums of the vectors that changed cluster.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import stage
from daymill.llm.vectors import SLACK, gap, largest_other, lists, matrix, moved_sums, nearest, to_own, whole_numbers

ENTRY = "vec_id long, v array<int>, cluster int, was int, key double"


def starting_points(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``, in that order; rows without vec_id last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def _push(entries: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """New heap entries of vectors compared with all centroids."""

    def run(batches):
        for batch in batches:
            v = matrix(batch, "v")
            if not len(v):
                continue
            cluster, first, second = nearest(v, centroids)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column(batch.schema.get_field_index("vec_id")),
                    "v": lists(v, pa.int32()),
                    "cluster": pa.array(cluster, pa.int32()),
                    "was": batch.column(batch.schema.get_field_index("was")),
                    "key": pa.array(gap(first, second) + drift[cluster]),
                }
            )

    return stage(entries.mapInArrow(run, ENTRY).sortWithinPartitions("cluster", "key"), "heap-run")


def _reached(drift: np.ndarray):
    """Whether a cluster's drift has come up to an entry's key."""
    return reduce(lambda a, b: a | b, ((F.col("cluster") == c) & (F.col("key") <= float(d)) for c, d in enumerate(drift)))


def _in_heap(runs: list[DataFrame], drifts: list[np.ndarray]) -> DataFrame:
    """What is in the heap after the pops of the last of ``drifts``; the newest run is there as a whole if none popped it."""
    kept = [run if at + 1 >= len(drifts) else run.filter(~_reached(drifts[-1])) for at, run in enumerate(runs)]
    return reduce(DataFrame.union, kept)


def heap_clusters(vectors: DataFrame, column: str, dim: int = 64, k: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1"):
    """Assignments (vec_id, v, cluster) to the centroids after ``rounds`` rounds, and these centroids.

    Both are None if no vector is kept.
    """
    kept = whole_numbers(vectors, column, scale, dim).select("vec_id", "v", F.lit(-1).alias("was"))
    centroids = starting_points(kept, k, seed)
    if not len(centroids):
        return None, None
    sums, counts = np.zeros(centroids.shape, object), np.zeros(len(centroids), object)
    drifts = [np.zeros(len(centroids))]
    runs = [_push(kept, centroids, drifts[0])]
    for _ in range(rounds):
        more, gained = moved_sums(runs[-1], "cluster", "was", (1, *centroids.shape))
        counts, sums = counts + more[0], sums + gained[0]
        before, used = centroids, counts > 0
        centroids = centroids.copy()
        centroids[used] = (sums[used] // counts[used, None]).astype(np.int64)
        step = np.sqrt(((centroids - before) ** 2).sum(1).astype(np.float64))
        drifts.append((drifts[-1] + step + largest_other(step)) * (1 + SLACK))
        due = _in_heap(runs, drifts[:-1]).filter(_reached(drifts[-1]))
        runs.append(_push(due.select("vec_id", "v", F.col("cluster").alias("was")), centroids, drifts[-1]))
    return _in_heap(runs, drifts).select("vec_id", "v", "cluster"), centroids


def cluster(vectors: DataFrame, column: str = "embedding", dim: int = 64, k: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Kept are vectors of ``dim`` components, none null or non-finite; each component x counts as
    floor(scale * x). Rows that repeat, or share a vec_id, are vectors of their own; a row
    without vec_id is clustered like any other but starts no cluster while others can. Ties go to
    the smaller cluster number. With fewer than k vectors there are as many clusters; without any the result
    is empty. Other columns are ignored.
    """
    spark = vectors.sparkSession
    assigned, centroids = heap_clusters(vectors.select("vec_id", column), column, dim, k, rounds, scale, seed)
    if assigned is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")

    def run(batches):
        for batch in batches:
            places = batch.column(batch.schema.get_field_index("cluster")).to_numpy()
            if len(places):
                far = to_own(matrix(batch, "v"), centroids, places)
                yield pa.RecordBatch.from_pydict({"vec_id": batch.column(batch.schema.get_field_index("vec_id")), "cluster": pa.array(places, pa.int32()), "distance": pa.array(far)})

    placed = stage(assigned.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    inertia = dict(placed.groupBy("cluster").agg(F.sum("distance")).collect())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, far, sum(inertia.values()), names[c]) for c, far in inertia.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
