"""Token ids as a compressed stream: static range asymmetric numeral systems.

The corpus counts its ids once and makes one shared table of frequencies. Ids go through it in
blocks that know nothing of each other. In a block, id number i belongs to lane i mod LANES, so
numpy codes all lanes at a time; whenever a lane's state would overflow, its low 32 bits go to
the block's one stream of words. At every checkpoint the block keeps the lanes' states and the
position in the stream, so segments between checkpoints can be decoded by different tasks. Each
segment has a checksum, and ends with a document.

Files, below one folder in the shared storage, all Parquet:
``table`` (id, count, frequency), ``blocks`` (part, block, first, payload, segments), where part
and block give the order, first is the number of ids of the part before the block, and a segment
holds at (first word), words, states, n_ids, crc32, doc_ids and doc_sizes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymill.llm import tokenize
from daymill.llm.common import stage, texts
from daymill.session import scratch_path

LANES = 2048
SEGMENT_IDS = 1 << 18
BLOCK_SEGMENTS = 4
SCALE_BITS = 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


# --- the code -------------------------------------------------------------------------


def scale(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies adding up to 2**bits, at least 1 for each count above 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    if len(used) > 1 << bits:
        raise ValueError(f"{len(used)} symbols need more than {bits} bits")
    out[used] = np.maximum(1, counts[used] * float(1 << bits) / counts[used].sum()).astype(np.int64)
    order = used[np.argsort(-out[used], kind="stable")]
    gap = (1 << bits) - int(out.sum())
    for s in order:
        step = max(gap, 1 - int(out[s])) if gap < 0 else gap
        out[s] += step
        gap -= step
        if not gap:
            return out
    return out


class Coder:
    """Encodes and decodes blocks by one table of frequencies (of symbols 0, 1, ...)."""

    def __init__(self, frequency: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.frequency = frequency.astype(np.uint64)
        self.start = (np.cumsum(frequency) - frequency).astype(np.uint64)
        self.most = self.frequency << np.uint64(63 - bits)
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)
        self.mask = np.uint64((1 << bits) - 1)

    def encode(self, segments: list[np.ndarray]) -> tuple[bytes, list[tuple[int, int, bytes]]]:
        """Words of a block, and per segment its first word, number of words and states."""
        state = np.full(LANES, _LOW, np.uint64)
        words: list[np.ndarray] = []
        kept: list[tuple[int, bytes]] = []
        for ids in reversed(segments):
            before = sum(map(len, words))
            for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
                s = ids[at : at + LANES]
                x = state[: len(s)]
                full = x >= self.most[s]
                words.append(x[full].astype(np.uint32))
                x = np.where(full, x >> _WORD, x)
                f = self.frequency[s]
                q = x // f
                state[: len(s)] = (q << self.bits) + (x - q * f) + self.start[s]
            kept.append((sum(map(len, words)) - before, state.astype("<u8").tobytes()))
        payload = np.concatenate(words[::-1] or [np.zeros(0, np.uint32)]).astype("<u4").tobytes()
        out, at = [], 0
        for count, states in reversed(kept):
            out.append((at, count, states))
            at += count
        return payload, out

    def decode(self, payload: bytes, states: bytes, n: int) -> np.ndarray:
        """The n ids of a segment from its own words and states."""
        words = np.frombuffer(payload, "<u4").astype(np.uint64)
        state = np.frombuffer(states, "<u8").astype(np.uint64)
        out, at = np.empty(n, np.uint32), 0
        for low in range(0, n, LANES):
            x = state[: min(LANES, n - low)]
            slot = x & self.mask
            s = self.symbol[slot]
            out[low : low + LANES] = s
            x = self.frequency[s] * (x >> self.bits) + slot - self.start[s]
            short = np.flatnonzero(x < _LOW)
            x[short] = (x[short] << _WORD) | words[at : at + len(short)]
            at += len(short)
            state[: len(x)] = x
        return out


# --- writing --------------------------------------------------------------------------


def _token_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids: little-endian, in two bytes each where the vocabulary allows it."""
    kind = _kind(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids in tokenize.encoder(tokenizer).arrays(batch.column(1), end_id, kind):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), ids.cast(pa.binary())], ["doc_id", "ids"])
                at += len(ids)

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def _kind(tokenizer: str) -> str:
    content = json.loads(tokenizer)
    largest = max([*content["model"]["vocab"].values(), *(t["id"] for t in content["added_tokens"])])
    return "<u2" if largest < 1 << 16 else "<u4"


def _counts(rows: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            cells = batch.column(0)
            ends = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1]
            ids = np.frombuffer(cells.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("count"))


_SEGMENT = "struct<at:long, words:long, states:binary, n_ids:long, crc32:long, doc_ids:array<long>, doc_sizes:array<long>>"
_BLOCKS = f"part int, block int, first long, payload binary, segments array<{_SEGMENT}>"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode all texts, each followed by ``end_id``, in ascending doc_id order, into ``path``.

    ``tokenizer`` is the content of a tokenizer file. A null or empty text is the end id alone.
    Rows without doc_id come first; rows with one doc_id are all written, in the order of their
    ids. An empty table gives an empty stream.
    """
    spark, kind = docs.sparkSession, _kind(tokenizer)
    rows = stage(_token_rows(docs, tokenizer, end_id), "token-ids")
    counts = _counts(rows, kind).toPandas().sort_values("id")
    dense = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    dense[counts["id"].to_numpy()] = counts["count"].to_numpy()
    counts["frequency"] = scale(dense)[counts["id"].to_numpy()]
    spark.createDataFrame(counts, "id long, count long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    frequency = scale(dense)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(frequency), TaskContext.get().partitionId()
        block, first = 0, 0
        segments: list[tuple[list[int | None], list[np.ndarray]]] = []
        filled = SEGMENT_IDS

        def flush() -> pa.RecordBatch:
            nonlocal block, first
            ids = [np.concatenate(s[1]) for s in segments]
            payload, marks = coder.encode(ids)
            cells = [
                {"at": at, "words": words, "states": states, "n_ids": len(x), "crc32": crc32(x.astype("<u4").tobytes()), "doc_ids": s[0], "doc_sizes": [len(y) for y in s[1]]}
                for (at, words, states), x, s in zip(marks, ids, segments, strict=True)
            ]
            row = {"part": part, "block": block, "first": first, "payload": payload, "segments": cells}
            block, first = block + 1, first + sum(map(len, ids))
            segments.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if filled >= SEGMENT_IDS:
                    if len(segments) == BLOCK_SEGMENTS:
                        yield flush()
                    segments.append(([], []))
                    filled = 0
                ids = np.frombuffer(raw, kind).astype(np.uint32)
                segments[-1][0].append(doc_id)
                segments[-1][1].append(ids)
                filled += len(ids)
        if segments:
            yield flush()

    segment = pa.struct([("at", pa.int64()), ("words", pa.int64()), ("states", pa.binary()), ("n_ids", pa.int64()), ("crc32", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("payload", pa.binary()), ("segments", pa.list_(segment))])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


# --- reading --------------------------------------------------------------------------


def read(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, first (ids of the part before it), n_ids, ids (little-endian, four bytes each).

    Segments are decoded each for itself; a checksum that differs is an error.
    """
    table = spark.read.parquet(f"{path}/table").toPandas()
    frequency = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.int64)
    frequency[table["id"].to_numpy()] = table["frequency"].to_numpy()
    before = F.aggregate(F.slice("all", 1, F.col("k")), F.lit(0).cast("long"), lambda a, s: a + s.n_ids)
    cut = (
        spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
        .select("part", "first", "payload", F.col("segments").alias("all"), F.posexplode("segments").alias("k", "s"))
        .select(
            "part",
            (F.col("first") + before).alias("first"),
            F.expr("substring(payload, cast(4 * s.at + 1 as int), cast(4 * s.words as int))").alias("payload"),
            "s.states", "s.n_ids", "s.crc32", "s.doc_ids", "s.doc_sizes",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequency)
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.decode(row["payload"], row["states"], row["n_ids"])
                if crc32(raw := ids.astype("<u4").tobytes()) != row["crc32"]:
                    raise ValueError(f"part {row['part']}: checksum of the segment at id {row['first']} differs")
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                cells = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + ends - sizes), pa.array(sizes), pa.array(cells, pa.binary())],
                    ["part", "doc_id", "first", "n_ids", "ids"],
                )

    return cut.mapInArrow(run, "part int, doc_id long, first long, n_ids long, ids binary")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, part_start: ids of all parts before. A row per part, so one window holds them."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sizes = F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + s.n_ids)
    totals = blocks.select("part", sizes.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def write_and_describe(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, read back from the files just written."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-stream")
    write(docs, path, tokenizer, end_id)
    decoded = read(spark, path)
    starts = part_starts(spark, path)
    return decoded.select("part", "doc_id", "first", "n_ids", F.crc32("ids").alias("ids_crc32")).join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("first")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32"
    )
