"""Incremental line dedup: sharded cuckoo filters in front of an exact reference-count table.

State is two tables. ``refs`` has one row per line key: how many documents hold it and the
smallest id among them, its owner. ``filters`` has one row per shard of keys: cuckoo filters of
all keys in ``refs``. A batch is first counted per key, so a line in a third of all documents is
one row; each shard then asks its filter, and only keys it may have seen are looked up in
``refs``. Deleting documents lowers the counts, takes keys that reach zero out of both, and
gives keys of deleted owners to the smallest document left. Inserting and deleting the same
documents restores every answer.

A key is the 128-bit hash of a line stripped at both ends and lower-cased (A-Z).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daymill.llm.common import binary_rows, empty_like, shards_for, stage

MIN_CHARS = 10
#: Lines expected in one shard when a state is begun, at most.
KEYS_PER_SHARD = 50_000
SLOTS = 4
#: Rounds of moving entries before a filter counts as full.
ROUNDS = 64
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes | None:
    """Key of a line, None if it is too short to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < MIN_CHARS or (not key.isascii() and len(key.decode("utf-8", "replace")) < MIN_CHARS):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, hi, lo: the distinct keys of each document. Rows without doc_id hold no keys."""

    def run(batches):
        for batch, rows in binary_rows(batches):
            index, keys = [], []
            for k, text in enumerate(rows):
                own = {key for line in text.split(b"\n") if (key := line_key(line))}
                index.extend([k] * len(own))
                keys.extend(own)
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc_id", "hi", "lo"]
            )

    return docs.select("doc_id", "text").filter("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, hi long, lo long")


# --- cuckoo filters -------------------------------------------------------------------


class Cuckoo:
    """16-bit fingerprints in buckets of four; a key's two buckets follow from each other by its fingerprint.

    All calls take arrays of keys, as the two halves of their hashes.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n) / (0.85 * SLOTS)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def places(self, hi: np.ndarray, lo: np.ndarray):
        mark = (lo.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        first = (hi.view(np.uint64) % np.uint64(len(self.table))).astype(np.int64)
        return mark, first, self.other(first, mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        spread = mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return bucket ^ (spread % np.uint64(len(self.table))).astype(np.int64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(hi, lo)
        return (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)

    def _put(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Fill free slots; which of the entries found one."""
        order = np.argsort(bucket, kind="stable")
        own = bucket[order]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        free = self.table[own] == 0
        fits = rank < free.sum(axis=1)
        slot = (np.cumsum(free, axis=1) == rank[:, None] + 1).argmax(axis=1)
        self.table[own[fits], slot[fits]] = mark[order][fits]
        done = np.zeros(len(mark), bool)
        done[order[fits]] = True
        return done

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """Insert an entry for each key. False if they do not all fit; the table is then as before."""
        before = self.table.copy()
        mark, bucket, _ = self.places(hi, lo)
        for turn in range(ROUNDS):
            for _ in range(2):
                left = ~self._put(mark, bucket)
                mark, bucket = mark[left], bucket[left]
                if not len(mark):
                    return True
                bucket = self.other(bucket, mark)
            # one entry a bucket moves out for one that waits
            _, one = np.unique(bucket, return_index=True)
            slot = turn % SLOTS
            out = self.table[bucket[one], slot].copy()
            self.table[bucket[one], slot] = mark[one]
            mark[one] = out
            bucket[one] = self.other(bucket[one], out)
        self.table = before
        return False

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Take out one fingerprint per key held; which keys were held."""
        mark, a, b = self.places(hi, lo)
        done = np.zeros(len(mark), bool)
        for bucket in (a, b):
            while True:
                there = self.table[bucket] == mark[:, None]
                open_ = np.flatnonzero(there.any(axis=1) & ~done)
                if not len(open_):
                    break
                place = bucket[open_] * SLOTS + there[open_].argmax(axis=1)
                _, one = np.unique(place, return_index=True)
                self.table.reshape(-1)[place[one]] = 0
                done[open_[one]] = True
        return done


def load(payload: bytes | None) -> Cuckoo:
    """The filter of a shard, an empty one if there is none yet."""
    if not payload:
        return Cuckoo.for_keys(0)
    return Cuckoo(np.frombuffer(payload, np.uint16).reshape(-1, SLOTS).copy())


def filter_of(hi: np.ndarray, lo: np.ndarray) -> Cuckoo:
    """A filter made of these keys alone, with room for as many more."""
    size = 2 * len(hi)
    while not (made := Cuckoo.for_keys(size)).insert(hi, lo):
        size = max(16, 2 * size)
    return made


# --- state ----------------------------------------------------------------------------

_REFS = "shard int, hi long, lo long, refs long, owner long"
_FILTERS = "shard int, payload binary"


@dataclass(frozen=True)
class State:
    shards: int
    refs: DataFrame
    filters: DataFrame


def empty_state(spark: SparkSession, shards: int) -> State:
    return State(shards, empty_like(spark, _REFS), empty_like(spark, _FILTERS))


def count_keys(keys: DataFrame) -> DataFrame:
    return keys.groupBy("hi", "lo").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner"))


def _sharded(counted: DataFrame, shards: int) -> DataFrame:
    return counted.select(F.pmod(F.xxhash64("hi", "lo"), F.lit(shards)).cast("int").alias("shard"), "hi", "lo", "refs", "owner")


def _through_filters(state: State, counted: DataFrame, change, label: str) -> DataFrame:
    """What ``change`` says of each key, as ``answer``, beside a row with the payload of each shard it has changed."""

    def run(key, rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        answer, payload = change(filters["payload"].iloc[0] if len(filters) else None, rows["hi"].to_numpy(), rows["lo"].to_numpy())
        out = rows.assign(answer=answer, payload=None)[columns]
        if payload is None:
            return out
        return pd.concat([out.astype(object), pd.DataFrame([{"shard": key[0], "payload": payload}])], ignore_index=True)[columns]

    columns = ["shard", "hi", "lo", "refs", "owner", "answer", "payload"]
    rows = _sharded(counted, state.shards).groupBy("shard")
    return stage(rows.cogroup(state.filters.groupBy("shard")).applyInPandas(run, _REFS + ", answer boolean, payload binary"), label)


def _ask(payload: bytes | None, hi: np.ndarray, lo: np.ndarray):
    """Which keys may be known."""
    return load(payload).contains(hi, lo), None


def _put(payload: bytes | None, hi: np.ndarray, lo: np.ndarray):
    """Enter each key; an answer of False marks a shard whose filter is full and has to be made anew."""
    if not payload:
        return True, filter_of(hi, lo).table.tobytes()
    own = load(payload)
    fits = own.insert(hi, lo)
    return fits, own.table.tobytes() if fits else None


def _take_out(payload: bytes | None, hi: np.ndarray, lo: np.ndarray):
    own = load(payload)
    return own.delete(hi, lo), own.table.tobytes()


def _changed_filters(state: State, out: DataFrame, label: str) -> DataFrame:
    """The filters with those shards replaced that ``out`` has a payload of."""
    changed = out.filter("payload IS NOT NULL").select("shard", "payload")
    return stage(state.filters.join(changed.select("shard"), "shard", "left_anti").union(changed), label)


def insert(state: State, docs: DataFrame, keys: DataFrame | None = None) -> State:
    """The state with these documents as well. They must not be in it yet.

    Every key in ``refs`` owns one entry of its shard's filter, also where another key has the same
    fingerprint: a key that the filter takes for known by mistake is found missing in ``refs`` and entered.
    """
    counted = stage(count_keys(line_keys(docs) if keys is None else keys), "line-counts")
    asked = _through_filters(state, counted, _ask, "line-asked")
    maybe = asked.filter("answer").select("hi", "lo", F.col("refs").alias("more"), F.col("owner").alias("other"))
    met = state.refs.join(maybe, ["hi", "lo"], "full").withColumn("is_new", F.col("refs").isNull())
    met = stage(
        met.select(
            F.coalesce("shard", F.pmod(F.xxhash64("hi", "lo"), F.lit(state.shards)).cast("int")).alias("shard"),
            "hi",
            "lo",
            (F.coalesce("refs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("refs"),
            F.least("owner", "other").alias("owner"),
            "is_new",
        ),
        "line-refs-met",
    )
    new = asked.filter("NOT answer").select(*state.refs.columns).union(met.filter("is_new").select(*state.refs.columns))
    refs = met.select(*state.refs.columns).union(asked.filter("NOT answer").select(*state.refs.columns))
    put = _through_filters(state, new.select("hi", "lo", "refs", "owner"), _put, "line-put")
    filters = _changed_filters(state, put, "line-filters")
    full = put.filter("NOT answer").select("shard").distinct()
    if not full.isEmpty():
        # a full filter is made anew from the exact keys of its shard, twice as large
        def again(key, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([{"shard": key[0], "payload": filter_of(rows["hi"].to_numpy(), rows["lo"].to_numpy()).table.tobytes()}])

        made = refs.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(again, _FILTERS)
        filters = stage(filters.join(full, "shard", "left_anti").union(made), "line-filters-anew")
    return State(state.shards, refs, filters)


def delete(state: State, gone: DataFrame, left: DataFrame) -> State:
    """The state without the documents ``gone``, of which all were in it; ``left`` are those that stay."""
    counted = count_keys(line_keys(gone)).withColumnsRenamed({"refs": "less", "owner": "was"})
    joined = state.refs.join(counted, ["hi", "lo"], "left").withColumn("now", F.col("refs") - F.coalesce("less", F.lit(0)))
    changed = stage(joined, "line-refs-less")
    orphans = changed.filter("now > 0 AND owner = was").select("hi", "lo")
    heirs = line_keys(left).join(orphans, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(F.min("doc_id").alias("heir"))
    refs = changed.filter("now > 0").join(heirs, ["hi", "lo"], "left").select(
        "shard", "hi", "lo", F.col("now").alias("refs"), F.coalesce("heir", "owner").alias("owner")
    )
    ended = changed.filter("now = 0").select("hi", "lo", F.lit(0).alias("refs"), "owner")
    out = _through_filters(state, ended, _take_out, "line-filters-less")
    return State(state.shards, stage(refs, "line-refs"), _changed_filters(state, out, "line-filters"))


# --- dropping lines -------------------------------------------------------------------


def drop_lines(docs: DataFrame, state: State, keys: DataFrame | None = None) -> DataFrame:
    """row (a struct of all columns of ``docs``), text (the lines that stay), n_lines, n_dropped.

    A line goes if two documents or more hold its key and this one is not the key's owner.
    Lines of under MIN_CHARS code points always stay, and so do all lines of rows without
    doc_id. Lines are what stands between line feeds; a null or empty text is one empty line.
    Rows with one doc_id count as documents each and keep or lose the same lines.
    """
    shared = state.refs.filter("refs > 1").select("hi", "lo", "owner")
    own = line_keys(docs) if keys is None else keys
    lost = (
        own.join(shared, ["hi", "lo"])
        .filter("doc_id != owner")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("hi", "lo")).alias("lost"))
        .withColumnRenamed("doc_id", "lost_id")
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(lost, F.col("row.doc_id") == F.col("lost_id"), "left").select(
        "row", F.col("lost.hi").alias("hi"), F.col("lost.lo").alias("lo")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_ = batch.column(0).field("text").cast(pa.large_binary())
            his, los = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("hi", "lo"))
            kept, n_lines, n_dropped = [], [], []
            for cell, hi, lo in zip(rows_, his, los, strict=True):
                lines = (cell.as_py() or b"").split(b"\n")
                stay = lines
                if hi:
                    gone = np.column_stack([hi, lo]).astype(np.int64).tobytes()
                    drop = {gone[i : i + 16] for i in range(0, len(gone), 16)}
                    stay = [x for x in lines if line_key(x) not in drop]
                kept.append(b"\n".join(stay).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], ["row", "text", "n_lines", "n_dropped"])

    counts = [StructField(c, LongType()) for c in ("n_lines", "n_dropped")]
    return joined.mapInArrow(run, StructType([rows.schema["row"], StructField("text", StringType()), *counts]))


def dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """``drop_lines`` of documents against a state made of just these documents, inserted in batches.

    From the second batch on the filters decide which keys are looked up in the exact counts. The
    batches are cut by a hash of the id; their number changes no result.
    """
    keys = stage(line_keys(docs), "line-keys")
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = empty_state(spark, max(least, shards_for(keys.count(), KEYS_PER_SHARD)))
    for batch in range(batches):
        own = keys.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch)
        state = insert(state, docs, own)
    return drop_lines(docs, state, keys)
