"""Best-fit packing by bin completion.

Only the lengths of pieces matter for a packing, and there are at most as many lengths as a
sequence has places. So tasks count the lengths, the counts are packed into patterns (what one
sequence holds, and how often), and every piece finds its place from its rank among pieces of
its length. The counts are the only thing the driver sees; they do not grow with the corpus.

Patterns come from bin completion. Best-fit decreasing gives the first solution. Then, around
the largest length left, undominated fillings of the rest of a sequence are enumerated, least
waste first; a branch ends once its waste leaves no room for fewer sequences than the best
solution has, and best-fit decreasing of what is left may improve the best at every node. The search ends at the
lower bound or after a number of nodes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymill.llm import tokenize
from daymill.llm.common import shards_for, stage, texts

#: Nodes of the search.
NODES = 4000
#: Fillings of up to so many pieces are compared, with so many before them.
COMPARED = 8
#: Up to so many pieces the search decides on one sequence at a time, above on all equal ones.
SINGLY = 200
#: Pieces of one length that are ranked in one group.
RANKED_TOGETHER = 1000

Pattern = tuple[tuple[int, int], ...]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counted lengths: patterns (length, copies) and how often each is used."""
    open_: dict[int, list[list]] = {}
    done: list[tuple[Pattern, int]] = []

    def add(pattern: Pattern, room: int, times: int) -> None:
        if times:
            (open_.setdefault(room, []) if room else done).append((pattern, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                pattern, times, room = (), left, capacity
            else:
                pattern, times = open_[room].pop()
                if not open_[room]:
                    del open_[room]
            copies = min(room // length, left)
            full = min(times, left // copies)
            add((*pattern, (length, copies)), room - copies * length, full)
            left -= full * copies
            if pattern:
                add(pattern, room, times - full)
    return done + [(p, t) for bins in open_.values() for p, t in bins]


def bins(solution: list[tuple[Pattern, int]]) -> int:
    return sum(times for _, times in solution)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by total, and for each k by the pieces of which no k + 1 share a sequence."""
    total = sum(x * c for x, c in counts.items())
    together = (-(-sum(c for x, c in counts.items() if (k + 1) * x > capacity) // k) for k in range(1, 9))
    return max(-(-total // capacity), *together)


def fits_into(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the pieces ``small`` can be dealt to places of the sizes ``large``."""
    if not small:
        return True
    for k in range(len(large)):
        if large[k] >= small[0] and large[k] not in large[:k]:
            if fits_into(small[1:], (*large[:k], large[k] - small[0], *large[k + 1 :])):
                return True
    return False


def reachable(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """Per position in ``lengths`` the sums up to ``room`` that pieces from there on come to, as bits of a number."""
    most, sums = (1 << (room + 1)) - 1, 1
    out = [sums]
    for x in reversed(lengths):
        left, step = min(counts[x], room // x), 1
        while left:
            step = min(step, left)
            sums |= sums << (x * step) & most
            left, step = left - step, 2 * step
        out.append(sums)
    return out[::-1]


def exact_fillings(counts: dict[int, int], lengths: list[int], sums: list[int], total: int) -> Iterator[tuple[int, ...]]:
    """Every choice of pieces that comes to ``total``, long ones first; no step is taken that cannot be completed."""
    waiting = [(0, total, ())]
    while waiting:
        at, left, chosen = waiting.pop()
        if not left:
            yield chosen
            continue
        follow = []
        for k in range(at, len(lengths)):
            if not sums[k] >> left & 1:
                break
            x = lengths[k]
            used = chosen.count(x)
            for copies in range(1, min(counts[x] - used, left // x) + 1):
                if sums[k + 1] >> (left - copies * x) & 1:
                    follow.append((k + 1, left - copies * x, chosen + (x,) * copies))
        waiting.extend(reversed(follow))


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, ...]]:
    """Undominated maximal fillings of ``room`` with at most ``waste`` left over, least waste first, one at a time.

    A filling is dominated if its pieces fit into the places of another one's pieces. Sums that no
    pieces come to are known beforehand, so the pieces that close a sequence are found at once.
    """
    lengths = sorted((x for x in counts if x <= room and counts[x]), reverse=True)
    sums = reachable(counts, lengths, room)
    given: list[tuple[int, ...]] = []
    for left in range(min(waste, room) + 1):
        if not sums[0] >> (room - left) & 1:
            continue
        for filling in exact_fillings(counts, lengths, sums, room - left):
            used = Counter(filling)
            if any(x <= left and used[x] < counts[x] for x in reversed(lengths)):
                continue
            if len(filling) <= COMPARED and any(fits_into(filling, g) for g in given if len(g) <= COMPARED):
                continue
            given = given[-COMPARED:] + [filling]
            yield filling


def pack(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns for counted lengths in as few sequences as the search finds.

    Depth first. An open node is its path and how many of its fillings were tried; only the newest
    one holds what it enumerates from, others work it out again when the search comes back to them.
    """
    counts = {x: c for x, c in counts.items() if c}
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    fewest, total = bins(best), sum(x * c for x, c in counts.items())
    singly = sum(counts.values()) <= SINGLY
    open_: list[list] = [[(), 0, 0]] if counts else []
    newest, nodes = None, 0
    while open_ and fewest > bound and nodes < NODES:
        node = open_[-1]
        path, wasted, tried = node
        allowed = (fewest - 1) * capacity - total - wasted
        if newest is not node:
            left = _left(counts, path)
            newest, options = node, islice(_node_fillings(left, capacity, allowed), tried, None)
        filling = next(options, None)
        node[2] += 1
        largest = max(left)
        waste = capacity - largest - sum(filling) if filling is not None else 0
        if filling is None or waste > allowed:  # later fillings waste no less
            open_.pop()
            continue
        own = Counter((largest, *filling))
        times = 1 if singly else min(left[x] // c for x, c in own.items())
        times = min(times, allowed // waste) if waste else times
        nodes += 1
        way = (tuple(sorted(own.items(), reverse=True)), times, path)
        after = _left(left, (*way[:2], ()))
        used, wasted = _length(way), wasted + waste * times
        if used + lower_bound(after, capacity) >= fewest:
            continue
        rest = best_fit(after, capacity)
        if used + bins(rest) < fewest:
            best, fewest = _patterns(way) + rest, used + bins(rest)
        if after:
            open_.append([way, wasted, 0])
    return best


def _left(counts: dict[int, int], path: tuple) -> dict[int, int]:
    """What a path of patterns leaves of the counts."""
    left = dict(counts)
    while path:
        for x, c in path[0]:
            left[x] -= c * path[1]
        path = path[2]
    return {x: c for x, c in left.items() if c}


def _node_fillings(left: dict[int, int], capacity: int, allowed: int) -> Iterator[tuple[int, ...]]:
    """What can stand beside the largest piece left."""
    largest = max(left)
    return fillings(left | {largest: left[largest] - 1}, capacity - largest, allowed)


def _length(path: tuple) -> int:
    n = 0
    while path:
        n += path[1]
        path = path[2]
    return n


def _patterns(path: tuple) -> list[tuple[Pattern, int]]:
    out = []
    while path:
        out.append((path[0], path[1]))
        path = path[2]
    return out


def places(solution: list[tuple[Pattern, int]]) -> pd.DataFrame:
    """For each length the ranks from ``rank`` on: first sequence, copies in each, offset of the first copy."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in solution:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], sequence, copies, offset))
            used[length] += copies * times
            offset += copies * length
        sequence += times
    frame = pd.DataFrame(rows, columns=["length", "rank", "sequence", "copies", "offset"], dtype="int64")
    return frame.sort_values(["length", "rank"], ignore_index=True)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32. Only documents longer than a sequence are cut; their first piece takes the remainder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, rows = [], []
            for k, ids in enumerate(tokenize.encoder(tokenizer).documents(batch.column(1), end_id)):
                raw, n = memoryview(ids.astype("<u4").tobytes()), len(ids)
                at, to, piece = 0, n % capacity or capacity, 0
                while at < n:
                    to = min(to, n)
                    rows.append((piece, at, to - at, crc32(raw[4 * at : 4 * to])))
                    index.append(k)
                    at, to, piece = to, to + capacity, piece + 1
            table = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), pa.array(table[:, 0].astype(np.int32)), *(pa.array(table[:, k]) for k in (1, 2, 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    ``tokenizer`` is the content of a tokenizer file. A null or empty text is the end id alone.
    Repeated rows are packed each. An empty table gives an empty one.
    """
    cut = stage(pieces(docs, tokenizer, capacity, end_id), "packing-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    where = places(pack(counts, capacity))
    salts = shards_for(max(counts.values(), default=0), RANKED_TOGETHER)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("own", F.row_number().over(own) - 1)
        .join(groups, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank"))
    )
    key = where["length"].to_numpy() << 40 | where["rank"].to_numpy()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame.pop("rank").to_numpy()
            at = where.iloc[np.searchsorted(key, length << 40 | rank, "right") - 1]
            inside = rank - at["rank"].to_numpy()
            yield frame.assign(
                sequence_id=at["sequence"].to_numpy() + inside // at["copies"].to_numpy(),
                offset=at["offset"].to_numpy() + inside % at["copies"].to_numpy() * length,
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInPandas(run, schema)
