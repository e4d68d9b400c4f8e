"""Removal of repeated byte strings by bucket-pointer refinement.

Every byte of a string of LENGTH bytes that also starts elsewhere goes. Of the suffixes, only
the first LENGTH bytes matter, so refinement stops there.

Buckets of suffixes are first dealt out by a q-gram: the smallest hash among the q-grams of a
window of LENGTH bytes marks its anchor. Equal windows have equal anchors at the same distance,
and all windows with one anchor form a stretch of the text, so a stretch, not each byte, is
a row. Anchors whose q-gram occurs once are done: their windows occur once. If all stretches of
a bucket are equal, all their windows repeat. Only stretches that differ within a bucket are
read byte by byte: their suffixes are refined by sorting on (own bucket, bucket of the suffix k
bytes later), k = 8, 16, ..., where each round uses the bucket numbers of the last one and leaves
out suffixes already alone in their bucket. A bucket with more different stretches than one task should hold is split by the
windows' hashes instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import runs, stage, texts

LENGTH = 200
GRAM = 32
CHUNK_BYTES = 512 << 10
#: Different stretches of one bucket that a task refines together.
TOGETHER = 4_000
#: Bytes of stretches refined in one go.
REFINED_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- anchors --------------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each place on, by doubling; the last ones run out of the data and mean nothing."""
    x = data.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        x[:-step] |= x[step:] << np.uint64(bits)
    for step in (8, 16):
        y = x.copy()
        y[:-step] += x[step:] * _MIX
        x = (y ^ (y >> np.uint64(31))) * _MIX
        x ^= x >> np.uint64(29)
    return x


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from each place on, for places that have so many."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(block, axis=1).reshape(-1)
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def anchors(data: bytes, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: text, gram hash, first and last window (places in ``data``) of each anchor."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    if len(data) < length:
        return none
    raw = np.frombuffer(data, np.uint8)
    gram = gram_hashes(raw)
    key = gram & np.uint64(0xFFFFFFFF00000000) | np.arange(len(raw), dtype=np.uint64)
    least = window_minimum(key[: len(raw) - GRAM + 1], length - GRAM + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.append(0, ends[:-1])
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + length <= ends[text])
    if not len(inside):
        return none
    own, doc = anchor[inside], text[inside]
    new = np.append(True, (own[1:] != own[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return doc[first], gram[own[first]], inside[first], inside[last]


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Name of a row by its id and its text; rows equal in both share all that is found."""
    return [F.coalesce(doc_id, F.lit(0)).alias("d"), F.xxhash64(text).alias("t")]


def stretches(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """d, t, gram, whole (hash of the stretch's bytes), low, high: first and last window of the stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).cast(pa.large_binary())
            sizes = np.array([len(x.as_buffer()) for x in rows], np.int64)
            group = np.cumsum(sizes) // CHUNK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(rows)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                data = b"".join(rows.slice(a, b - a).to_pylist())
                ends = np.cumsum(sizes[a:b])
                doc, gram, low, high = anchors(data, ends, length)
                view = memoryview(data)
                whole = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[x : y + length]) for x, y in zip(low.tolist(), high.tolist(), strict=True)), np.uint64, len(low)
                )
                shift = (ends - sizes[a:b])[doc] if len(doc) else low
                at = pa.array(doc + a)
                columns = [batch.column(0).take(at), batch.column(1).take(at), gram.view(np.int64), whole.view(np.int64), low - shift, high - shift]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], _STRETCH)

    rows = texts(docs).select(*row_key(F.col("doc_id"), F.col("text")), "text")
    return rows.mapInArrow(run, "d long, t long, gram long, whole long, low long, high long")


_STRETCH = ["d", "t", "gram", "whole", "low", "high"]


# --- refinement -----------------------------------------------------------------------


def refine(data: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Bucket numbers of suffixes by their first ``length`` bytes; -1 where fewer are left.

    left: bytes from each place to the end of its string. Equal numbers mean equal bytes.
    """
    n, width = len(data), min(GRAM, length)
    bucket = np.full(n, -1, np.int64)
    able = np.flatnonzero(left >= width)
    first = gram_hashes(data) if width == GRAM else data.astype(np.uint64)
    if width < GRAM:  # strings too short for a q-gram begin with single bytes
        width = 1
        able = np.flatnonzero(left >= 1)
    _, bucket[able] = np.unique(first[able], return_inverse=True)
    while width < length:
        step = min(width, length - width)
        able = np.flatnonzero(left >= width + step)
        own = bucket[able]
        many = (np.bincount(own, minlength=1) > 1)[own]
        # a suffix alone in its bucket stays alone: it gets a number of its own above all others
        number = np.full(n, -1, np.int64)
        number[able[~many]] = n + able[~many]
        shared = able[many]
        _, number[shared] = np.unique(bucket[shared] * np.int64(2 * n) + bucket[shared + step], return_inverse=True)
        bucket, width = number, width + step
    return bucket


def repeated_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string which of its windows occur at another place among all strings, as window starts."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    bucket = refine(data, left, length)
    whole = bucket >= 0
    count = np.bincount(bucket[whole], minlength=1)
    again = np.zeros(len(data), bool)
    again[whole] = count[bucket[whole]] > 1
    return [np.flatnonzero(x) for x in np.split(again, ends[:-1])]


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes covered by windows with the given ascending starts."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + length


def _refined(kinds: DataFrame, length: int) -> DataFrame:
    """d, t, low, high (bytes) of repeated windows of single stretches, from the stretches of whole buckets with their bytes."""

    def work(whole: pd.DataFrame) -> pd.DataFrame:
        found = repeated_windows(whole["bytes"].tolist(), length)
        out = []
        for d, t, low, n, starts in zip(whole["d"], whole["t"], whole["low"], whole["n"], found, strict=True):
            if n == 1 and len(starts):
                a, b = spans(starts, length)
                out.append(pd.DataFrame({"d": d, "t": t, "low": low + a, "high": low + b}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("d", "t", "low", "high")})

    def parts(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Whole buckets of about REFINED_BYTES together."""
        starts = runs(rows["gram"].to_numpy())[:-1]
        before = np.append(0, rows["bytes"].str.len().cumsum().to_numpy()[:-1])[starts]
        firsts = starts[np.unique(before // REFINED_BYTES, return_index=True)[1]].tolist()
        for a, b in zip(firsts, [*firsts[1:], len(rows)], strict=True):
            yield rows.iloc[a:b]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += int(frame["bytes"].str.len().sum())
            if size < REFINED_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(rows["gram"].to_numpy(), rows["gram"].iloc[-1]))
            yield from map(work, parts(rows.iloc[:cut]))
            rows = rows.iloc[cut:]
            held, size = [rows], int(rows["bytes"].str.len().sum())
        if held:
            yield from map(work, parts(pd.concat(held, ignore_index=True)))

    return kinds.repartition("gram").sortWithinPartitions("gram").mapInPandas(run, "d long, t long, low long, high long")


def _by_window(kinds: DataFrame, length: int) -> DataFrame:
    """The same for buckets with very many different stretches: windows meet by their 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, n = row["bytes"], len(row["bytes"]) - length + 1
                names = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n)), np.int64).reshape(-1, 2)
                same = lambda c, n=n, row=row: pa.array(np.full(n, row[c], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[:, 0]), pa.array(names[:, 1]), same("d"), same("t"), pa.array(np.arange(n) + row["low"]), same("n")],
                    ["w1", "w2", "d", "t", "low", "n"],
                )

    windows = kinds.select("d", "t", "low", "n", "bytes").mapInArrow(run, "w1 long, w2 long, d long, t long, low long, n long")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("c")).filter("c > 1").select("w1", "w2")
    return windows.filter("n = 1").join(twice, ["w1", "w2"], "left_semi").select("d", "t", "low", (F.col("low") + length).alias("high"))


# --- the operator ---------------------------------------------------------------------


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, d, t, packed: texts compressed for the shuffles ahead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = [pack.compress(x) for x in batch.column(3).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.binary())], ["doc_id", "d", "t", "packed"])

    rows = texts(docs).select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    return rows.mapInArrow(run, "doc_id long, d long, t long, packed binary")


def _with_bytes(docs: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """Stretches with their bytes: gram, n, d, t, low, bytes."""
    wanted = kinds.groupBy("d", "t").agg(F.collect_list(F.struct("gram", "n", "low", "high", "many")).alias("cuts"))
    joined = _packed(docs).drop("doc_id").dropDuplicates(["d", "t"]).join(wanted, ["d", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            cuts, packed = batch.column(3), batch.column(2)
            row = np.repeat(np.arange(len(batch)), np.asarray(cuts.value_lengths()))
            fields = dict(zip(("gram", "n", "low", "high", "many"), cuts.flatten().flatten(), strict=True))
            pieces, at, text = [], -1, b""
            for r, a, b in zip(row.tolist(), fields["low"].to_pylist(), fields.pop("high").to_pylist(), strict=True):
                if r != at:
                    at, text = r, unpack.decompress(packed[r].as_py())
                pieces.append(text[a : b + length])
            own = {"d": batch.column(0).take(pa.array(row)), "t": batch.column(1).take(pa.array(row))}
            yield pa.RecordBatch.from_pydict({**{c: fields[c] for c in ("gram", "n")}, **own, "low": fields["low"], "many": fields["many"], "bytes": pa.array(pieces, pa.binary())})

    return joined.select("d", "t", "packed", "cuts").mapInArrow(run, "gram long, n long, d long, t long, low long, many boolean, bytes binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """d, t, low, high: byte ranges covered by repeated windows; they may overlap and repeat."""
    rows = stage(stretches(docs, length), "byte-stretches")
    buckets = rows.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")).filter("n > 1")
    again = stage(rows.join(buckets.select("gram", (F.col("a") != F.col("b")).alias("mixed")), "gram"), "byte-buckets")
    as_bytes = lambda df: df.select("d", "t", "low", (F.col("high") + length).alias("high"))
    mixed = again.filter("mixed")
    kinds = mixed.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "low", "high")).alias("one"))
    kinds = stage(kinds.select("gram", "whole", "n", "one.*"), "byte-kinds")
    equal = mixed.join(kinds.filter("n > 1").select("gram", "whole"), ["gram", "whole"], "left_semi")
    large = kinds.groupBy("gram").agg((F.count("*") > TOGETHER).alias("many"))
    cut = stage(_with_bytes(docs, kinds.join(large, "gram"), length), "byte-strings")
    return (
        as_bytes(again.filter("NOT mixed"))
        .union(as_bytes(equal))
        .union(_refined(cut.filter("NOT many"), length))
        .union(_by_window(cut.filter("many"), length))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) and its sha256 of every whole text.

    Texts are their UTF-8 bytes, so what stays may end within a character. Windows do not cross
    texts; those of repeated rows count as occurring at different places. A null or empty text,
    and one shorter than ``length``, keeps all its bytes. Further columns are not carried.
    """
    ranges = repeated_spans(docs, length).groupBy("d", "t").agg(F.collect_set(F.struct("low", "high")).alias("cuts"))
    joined = _packed(docs).join(ranges, ["d", "t"], "left").select("doc_id", "packed", F.col("cuts.low").alias("low"), F.col("cuts.high").alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, low, high in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                text = unpack.decompress(packed)
                kept, at, n_spans = [], 0, 0
                begin = end = -1
                for a, b in [*sorted(zip(low or [], high or [], strict=True)), (len(text) + 1, len(text) + 1)]:
                    if a <= end:
                        end = max(end, b)
                        continue
                    if end >= 0:
                        kept.append(text[at:begin])
                        at, n_spans = end, n_spans + 1
                    begin, end = a, b
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((len(text), len(text) - len(rest), n_spans, rest, sha256(rest).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
