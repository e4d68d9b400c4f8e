"""SimHash near-dedup: fingerprints linked within a Hamming radius, found in BK-trees.

Equal fingerprints are one node. Two nodes within the radius r agree on at least b - r of b
blocks of bits, so nodes are dealt to one bucket per choice of b - r blocks. Each bucket is a
shard with a BK-tree of its own: a node's children are keyed by their integer Hamming distance
to it, and a search at distance d follows only the edges d - r to d + r. A bucket that outgrows
a bound is split into several bounded trees, and every part of the bucket searches every tree;
no pair is lost and no task holds more than two parts. Within a task the trees are one forest,
built and searched level by level. A bucket reports a star per group it finds, not all its
pairs; the stars are joined by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import batch_of, binary_rows, components, runs, stage, texts

SEED = 42
#: Nodes of one tree, and of one set of searches, at most.
TREE_NODES = 1024
#: More blocks are taken once a bucket is expected to hold more nodes than this.
BUCKET_NODES = 256
#: Pairs of search and node looked at in one step, at most.
PAIRS_AT_ONCE = 1 << 19


# --- fingerprints ---------------------------------------------------------------------


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    A bit is set if it is set in more than half of the shingles' hashes.
    """
    words = text.lower().split()
    n = max(1, len(words) - shingle + 1)
    if not words:
        return 0
    if n == 1:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long); null texts count as empty."""

    def run(batches):
        for batch, rows in binary_rows(batches):
            fps = np.array([fingerprint(t, shingle) for t in rows], np.uint64).view(np.int64)
            yield batch_of(batch, ["doc_id"], fp=pa.array(fps))

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


# --- BK-trees -------------------------------------------------------------------------


class Forest:
    """BK-trees over ``fps``; tree t has the nodes from starts[t] up to starts[t + 1].

    Fingerprints of one tree differ. All nodes below a node arrive at it in the same round,
    so each round gives every (node, distance) its child: the first to arrive there.
    """

    def __init__(self, fps: np.ndarray, starts: np.ndarray):
        n = len(fps)
        self.fps = fps
        self.roots = starts[:-1]
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        waiting = np.setdiff1d(np.arange(n), self.roots, assume_unique=True)
        at = np.repeat(self.roots, np.diff(starts))[waiting]
        while len(waiting):
            distance = np.bitwise_count(fps[waiting] ^ fps[at]).astype(np.int64)
            _, first, same = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            child = waiting[first]
            parent[child], edge[child] = at[first], distance[first]
            at = child[same]
            rest = at != waiting
            waiting, at = waiting[rest], at[rest]
        kids = np.flatnonzero(parent >= 0)
        self.key = parent[kids] * 65 + edge[kids]
        order = np.argsort(self.key, kind="stable")
        self.key, self.child = self.key[order], kids[order]
        self.leaf = np.ones(n, bool)
        self.leaf[parent[kids]] = False

    def search(self, query: np.ndarray, root: np.ndarray, radius: int):
        """Pairs (index into query, node) within the radius, searched from the given roots."""
        q, node = np.arange(len(query)), root
        found_q, found_node = [], []
        while len(q):
            distance = np.bitwise_count(query[q] ^ self.fps[node]).astype(np.int64)
            near = distance <= radius
            found_q.append(q[near])
            found_node.append(node[near])
            inner = ~self.leaf[node]
            q, node, distance = q[inner], node[inner], distance[inner]
            low = np.searchsorted(self.key, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(distance + radius, 64), "right")
            count = high - low
            q = np.repeat(q, count)
            shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            node = self.child[np.repeat(low, count) + shift]
        return np.concatenate(found_q or [q]), np.concatenate(found_node or [q])


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node 0..n-1 the smallest node reachable over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Stars of the groups found in whole buckets: fingerprint a, smallest fingerprint b of its group."""
    fps = frame["fp"].to_numpy().view(np.uint64)
    starts = runs(*(frame[c].to_numpy() for c in GROUP))
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    shard, i, j = (frame[c].to_numpy() for c in ("shard", "tree", "seeker"))
    nodes, seekers = np.flatnonzero(shard == i), np.flatnonzero(shard == j)
    tree_starts = runs(group[nodes])
    forest = Forest(fps[nodes], tree_starts)
    tree_of = np.full(len(starts), -1, np.int64)
    tree_of[group[nodes[tree_starts[:-1]]]] = np.arange(len(tree_starts) - 1)
    tree = tree_of[group[seekers]]
    seekers, tree = seekers[tree >= 0], tree[tree >= 0]
    work = np.cumsum(np.diff(tree_starts)[tree])
    cuts = np.searchsorted(work, np.arange(PAIRS_AT_ONCE, (work[-1] if len(work) else 0), PAIRS_AT_ONCE))
    label = np.arange(len(fps))
    for part in np.split(np.arange(len(seekers)), cuts):
        q, node = forest.search(fps[seekers[part]], forest.roots[tree[part]], radius)
        left, right = label[seekers[part][q]], label[nodes[node]]
        apart = left != right
        label = smallest_reachable(len(fps), left[apart], right[apart])[label]
    moved = label != np.arange(len(fps))
    return pd.DataFrame({"a": fps[moved].view(np.int64), "b": fps[label[moved]].view(np.int64)})


GROUP = ("choice", "bits", "tree", "seeker")


def _whole_groups(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows, cut so that no group is split, of about ``rows`` rows."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) < rows:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = runs(*(whole[c].to_numpy() for c in GROUP))[-2]
        if last:
            yield whole.iloc[:last].reset_index(drop=True)
        held = [whole.iloc[last:]]
    if held and (whole := pd.concat(held, ignore_index=True)).size:
        yield whole


# --- the operator ---------------------------------------------------------------------


def block_choices(nodes: int, radius: int) -> list[int]:
    """Bit masks, each the union of b - radius of b blocks, with b fit to the number of nodes."""
    b = radius + 1
    while True:
        cuts = [64 * i // b for i in range(b + 1)]
        masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(b)]
        choices = [sum(c) for c in combinations(masks, b - radius)]
        if nodes >> min(c.bit_count() for c in choices) <= BUCKET_NODES or b == radius + 4:
            return choices
        b += 1


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints, as stars whose groups are those of all links."""
    choices = block_choices(fps.count(), radius)
    dealt = fps.select(
        "fp",
        F.explode(
            F.array(*(F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for k, m in enumerate(choices)))
        ).alias("k"),
    ).select("fp", "k.*")
    sizes = dealt.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / TREE_NODES).cast("int")
    placed = (
        dealt.join(sizes, ["choice", "bits"])
        .withColumn("parts", parts)
        .withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "choice",
            "bits",
            F.least("shard", "other").alias("tree"),
            F.greatest("shard", "other").alias("seeker"),
            "shard",
            "fp",
        )
    )

    def run(frames):
        for whole in _whole_groups(frames, 100_000):
            yield _links(whole, radius)

    return (
        placed.repartition(*GROUP)
        .sortWithinPartitions(*GROUP, "fp")
        .mapInPandas(run, "a long, b long")
    )


def group_documents(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links, itself included.

    Texts are lower-cased (A-Z), split at white space and cut into shingles of ``shingle``
    words; a shorter text is one shingle, one without words has fingerprint 0 and is linked
    like any other. A null text counts as empty. A row without doc_id keeps its row and takes
    the id of its group, null if no row of the group has one. Repeated rows stay repeated.
    """
    prints = stage(fingerprints(docs, shingle), "simhash-fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    groups = components(links(nodes.select("fp"), radius), "simhash-links")
    known = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    return prints.join(known.join(smallest, "label").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, of the smallest doc_id of each group.

    Of rows with one doc_id one stays. Rows without doc_id all stay.
    """
    groups = group_documents(docs.select("doc_id", "text"), shingle, radius)
    chosen = stage(groups.select(F.col("component_id").alias("doc_id")).filter("doc_id IS NOT NULL").distinct(), "simhash-kept")
    named = docs.filter("doc_id IS NOT NULL").join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.filter("doc_id IS NULL"))

