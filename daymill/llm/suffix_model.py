"""Language-model scoring with a probabilistic suffix tree over words.

A text is a start, its words and one end. A context is a sequence of up to DEPTH tokens before a
token; a state is a context whose next-token distribution diverges enough from that of its
suffix, which must be a state as well (the root always is). A gram, context and next token,
counts if it occurs MIN_COUNT times, whatever the size of the corpus. The tree grows level by
level, as tables of states and grams: a level's grams are counted exactly, dealt by their names
after each chunk of texts added up its own; gains are sums per context.
In shuffles the most frequent words go as ranks, the others by their names.

With c the count of state s, n those of its grams and r what other tokens had, the smoothed
probability is n / (c + PRIOR) plus (r + PRIOR) / (c + PRIOR) times that of the suffix, down to
add-one counts of single tokens at the root. A token is scored by its longest suffix that is a
state. So the score is the one by single tokens, plus for each place a factor: the deepest gram
found there, against its token at the root, times what deeper states leave to their suffix. Places that the most
frequent states and grams decide are scored where they are, as every task has those. Other
places and the part of the tree below their last token meet in one shard; frequent last tokens
have several shards, with a copy of their part in each.

Bitmaps of words, states and grams, of bounded size, spare places that cannot matter; the tables decide.
Words are named by 64-bit hashes in grams and by themselves in the counts of single tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymill.llm.common import runs, shards_for, stage, texts
from daymill.session import clear_scratch, scratch_path, shuffles_removed

DEPTH = 3
MIN_COUNT = 4
#: A context becomes a state if it gains so many nats, in all and per occurrence.
MIN_EVIDENCE = 12.0
MIN_DIVERGENCE = 0.02
PRIOR = 1.0
#: Bits of a bitmap of names, between these bounds as exponents of two; blocks are those of Spark's bitmap functions.
MAP_BITS, BLOCK_BITS = (20, 27), 15
#: Words whose counts are sent to the tasks, the most frequent ones; those of others are joined.
HEAD_WORDS = 300_000
#: States and grams that are sent to the tasks that score, the most frequent ones; places that meet others are dealt.
HEAD_NODES = 800_000
#: Places of one shard, about.
SHARD_PLACES = 2_000_000
CHUNK_BYTES = 8 << 20
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: In place of a token that no state has there, and of all words that occur too rarely for any gram.
NOTHING = np.uint64(0)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


# --- words ----------------------------------------------------------------------------


def word_chunks(column: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, pa.Array]]:
    """Slices of texts: first and last row, then row and word number of each word, and the distinct words."""
    column = column.cast(pa.large_string())
    group = np.cumsum(np.asarray(pc.binary_length(column)).astype(np.int64)) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low == high:
            continue
        part = column.slice(low, high - low)
        parts = pc.ascii_split_whitespace(pc.ascii_lower(part) if lower else part)
        bounds = np.asarray(parts.offsets)
        coded = parts.flatten().dictionary_encode()
        codes, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        row = np.repeat(np.arange(high - low), np.diff(bounds))
        blank = np.flatnonzero(np.asarray(pc.equal(words, "")))
        if len(blank):
            real = codes != blank[0]
            row, codes = row[real], codes[real]
        yield low, high, row, codes, words


def count_words(docs: DataFrame) -> DataFrame:
    """word, name, c: how often each word occurs. Counts are added up per task before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, codes, words in word_chunks(batch.column(0)):
                count = np.bincount(codes, minlength=len(words))
                used = np.flatnonzero(count)
                words = words.take(pa.array(used)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([words, pa.array(word_names(words).view(np.int64)), pa.array(count[used])], ["word", "name", "c"])

    counted = texts(docs).select("text").mapInArrow(run, "word string, name long, c long")
    return counted.groupBy("word").agg(F.first("name").alias("name"), F.sum("c").alias("c"))


def word_names(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_numpy(zero_copy_only=False)), np.uint64, len(words))


def mix(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Name of a context with one more token."""
    x = (context ^ (context >> np.uint64(29))) * _MIX + token
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def sequences(n: int, row: np.ndarray, codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of n texts in a row, start and end (codes ``words`` and ``words + 1``) around each: codes, text, tokens since the start."""
    size = np.bincount(row, minlength=n) + 2
    first = np.cumsum(size) - size
    token = np.empty(int(size.sum()), np.int64)
    token[first], token[first + size - 1] = words, words + 1
    token[np.arange(len(row)) + 2 * row + 1] = codes
    text = np.repeat(np.arange(n), size)
    return token, text, np.arange(len(token)) - first[text]


def tallied(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of codes below ``size``, and how often each occurs.

    Rows are folded into one integer each, so that values alone are sorted, no indexes.
    """
    bits = max(1, int(size).bit_length())
    key, width, folds = columns[0], bits, []
    for column in columns[1:]:
        if width + bits > 63:
            table, key = np.unique(key, return_inverse=True)
            width = len(table).bit_length()
            folds.append(table)
        key, width = key << bits | column, width + bits
        folds.append(None)
    key, n = np.unique(key, return_counts=True)
    rows = []
    for table in reversed(folds):
        if table is None:
            rows.append(key & ((1 << bits) - 1))
            key = key >> bits
        else:
            key = table[key]
    return [key, *reversed(rows)], n


# --- the tree -------------------------------------------------------------------------


def within(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand in a sorted array, and whether they do."""
    if not len(sorted_):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


class Index:
    """Sorted names of 64 bits, found by their first bits: hashes spread evenly, so few share those."""

    def __init__(self, names: np.ndarray):
        bits = max(1, len(names).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(names, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.size, self.names = len(names), np.append(names, np.uint64(2**64 - 1))

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where names stand, and whether they do."""
        at = self.starts[names >> self.shift].astype(np.int64)
        low = np.flatnonzero(self.names[at] < names)
        while len(low):
            at[low] += 1
            low = low[self.names[at[low]] < names[low]]
        return at, (self.names[at] == names) & (at < self.size)


# --- tokens by chunk ------------------------------------------------------------------


def _narrow(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes below ``size`` that occur, and each one's place among them, in few bytes."""
    if size > 4 * len(codes):
        used, at = np.unique(codes, return_inverse=True)
    else:
        flags = np.zeros(size, bool)
        flags[codes] = True
        used, at = np.flatnonzero(flags), (np.cumsum(flags) - 1)[codes]
    kind = np.uint8 if len(used) <= 1 << 8 else np.uint16 if len(used) <= 1 << 16 else np.uint32
    return used, at.astype(kind)


def packed(*columns: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Columns, each of values and codes that choose them, in few bytes: only the values used, small ascending ones as steps, and narrow codes.

    All are compressed as one, so that a column of few rows costs little more than its bytes.
    """
    sizes, body = [], []
    for values, codes in columns:
        used, at = _narrow(codes, len(values))
        values = values[used]
        ascending = len(values) and values[0] >= 0 and (values[1:] >= values[:-1]).all()
        small = int(np.searchsorted(values.astype(np.uint64), np.uint64(1 << 32))) if ascending else 0
        steps = np.diff(values[:small].astype(np.uint32), prepend=np.uint32(0))
        most = int(steps.max(initial=0))
        steps = steps.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
        sizes += [_KINDS.index(values.dtype), steps.itemsize, small, len(values) - small, at.itemsize, len(at)]
        body += [steps.tobytes(), values[small:].tobytes(), at.tobytes()]
    raw = b"".join([np.array([len(columns), *sizes], np.uint32).tobytes(), *body])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values and codes of each column."""
    raw = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    columns = int(np.frombuffer(raw, np.uint32, 1)[0])
    sizes = np.frombuffer(raw, np.uint32, 6 * columns, 4).astype(np.int64).reshape(columns, 6)
    start, out = 4 + sizes.nbytes // 2, []
    for kind, step, small, large, code, rows in sizes.tolist():
        parts = []
        for dtype, n in ((f"u{step}", small), (_KINDS[kind], large), (f"u{code}", rows)):
            parts.append(np.frombuffer(raw, dtype, n, start))
            start += parts[-1].nbytes
        steps, rest, codes = parts
        out.append((np.append(np.cumsum(steps, dtype=np.uint64).astype(rest.dtype), rest), codes))
    return out


_KINDS = [np.dtype(k) for k in ("u8", "i8", "i4")]


def named(ranks: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Names of tokens, of which the most frequent ones are given by their ranks, places in ``words``."""
    short = ranks < np.uint64(len(words))
    out = ranks.copy()
    out[short] = words[ranks[short].astype(np.int64)]
    return out


CHUNK_SCHEMA = "chunk long, n long, tokens binary, ids binary, sizes binary, learns binary"


def _chunk_row(chunk: int, ranks: np.ndarray, token: np.ndarray, text: np.ndarray, ids: np.ndarray, learn: np.ndarray) -> list[pa.Array]:
    """One row of CHUNK_SCHEMA: the tokens of some texts, as codes of ``ranks``, each text's row, and whether to learn from it."""
    sizes = np.bincount(text, minlength=len(ids)).astype(np.int64)
    kinds, code = np.unique(ranks, return_inverse=True)
    raw = [packed((kinds, code[token])), ids.astype(np.int64).tobytes(), sizes.tobytes(), learn.astype(bool).tobytes()]
    return [pa.array([x]) for x in (chunk, len(token), *raw)]


CHUNK = ["chunk", "tokens", "ids", "sizes", "learns"]
PLACES = ["shard", "chunk", "places", "gains"]


def _chunks(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[tuple]:
    """chunk, ids of its texts, ranks and names of tokens, then code, text number and tokens since the start of each place, and whether to learn from it.

    Ranks ascend; code 0 is that of no token.
    """
    for batch in batches:
        for chunk, raw, ids, sizes, learn in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            size = np.frombuffer(sizes, np.int64)
            text = np.repeat(np.arange(len(size)), size)
            since = np.arange(len(text)) - (np.cumsum(size) - size)[text]
            ((ranks, codes),) = unpacked(raw)
            ranks = np.append(NOTHING, ranks)
            yield chunk, np.frombuffer(ids, np.int64), ranks, named(ranks, words), codes.astype(np.int64) + 1, text, since, np.frombuffer(learn, bool)[text]


def _cut(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that has rows, with where they stand."""
    order = np.argsort(shard.astype(np.uint16 if shards <= 1 << 16 else np.uint32), kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    for k, (low, high) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
        if low < high:
            yield k, order[low:high]


@dataclass
class Bitmap:
    """Bits of hashed names: no for a name is certain."""

    bits: int
    flags: np.ndarray

    def may_have(self, names: np.ndarray) -> np.ndarray:
        cell = (names >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.flags[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(table: DataFrame, name: str) -> Bitmap:
    """Each task sends one bitmap a block, so what moves is bounded by tasks, not by rows."""
    bits = min(max(MAP_BITS[0], (16 * table.count()).bit_length()), MAP_BITS[1])
    # the built-in functions number cells from one, and blocks too
    cell = F.shiftrightunsigned(name, 64 - bits) + 1
    blocks = table.groupBy(F.bitmap_bucket_number(cell).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("flags"))
    out = np.zeros((1 << (bits - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for r in blocks.collect():
        out[r["block"] - 1] = np.frombuffer(r["flags"], np.uint8)
    return Bitmap(bits, out.reshape(-1))


# --- growing --------------------------------------------------------------------------


def _contexts(token: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    context = np.zeros(len(at), np.uint64)
    for k in range(1, depth + 1):
        context = mix(context, token[at - k])
    return context


def _names_of(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of a context without its first token, of the whole context and of the gram; ``tokens``: the context backwards, then the token."""
    suffix = context = np.zeros(len(tokens[0]), np.uint64)
    for t in tokens[:-1]:
        suffix, context = context, mix(context, t)
    return suffix, context, mix(context, tokens[-1])


def _count_grams(chunks: DataFrame, words: np.ndarray, depth: int, maps: list[tuple[Bitmap, Bitmap]], least: int, shards: int) -> DataFrame:
    """context, token, suffix, last, name, n of grams with ``depth`` tokens of context that come to ``least``.

    Rows with token 0 hold how often each context occurs. ``maps`` are those of the states and of the
    grams of each level before.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ranks, names, codes, _, since, learn in _chunks(batches, words):
            token = names[codes]
            counts = token != NOTHING
            at = np.flatnonzero(learn & (since >= depth))
            for k in range(1, depth + 1):
                at = at[counts[at - k]]
            for k, (states, grams) in enumerate(maps, 1):
                suffix = _contexts(token, at, k)
                able = states.may_have(suffix)
                if k == depth - 1:
                    # the context itself must be a frequent gram, where grams of that name were counted
                    before = at - 1
                    counted = np.ones(len(at), bool)
                    for j, (shorter, _) in enumerate(maps[: k - 1], 1):
                        counted &= shorter.may_have(_contexts(token, before, j))
                    able &= ~counted | grams.may_have(mix(_contexts(token, before, k), token[before]))
                at = at[able]
            near = [codes[at - k] for k in range(1, depth + 1)]
            rows, n = tallied(near, len(names))
            rows.append(np.zeros(len(n), np.int64))
            seen = counts[at]
            if depth > 1:
                seen &= maps[-1][1].may_have(mix(_contexts(token, at, depth - 1), token[at]))
            at, near = at[seen], [c[seen] for c in near]
            grams_, times = tallied([*near, codes[at]], len(names))
            rows, n = [np.concatenate(x) for x in zip(rows, grams_, strict=True)], np.append(n, times)
            shard = (_names_of([names[c] for c in rows])[2] % np.uint64(shards)).astype(np.int64)
            for k, part in _cut(shard, shards):
                # few rows differ in their number, so numbers are values with codes too
                raw = packed(*((ranks, c[part]) for c in rows), np.unique(n[part], return_inverse=True))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([raw])], ["shard", "grams"])

    def add(part: pa.Table) -> pa.Table:
        columns = zip(*([v[c] for v, c in unpacked(raw)] for raw in part.column("grams").to_pylist()), strict=True)
        *tokens, n = (np.concatenate(x) for x in columns)
        tokens = [named(t, words) for t in tokens]
        name = _names_of(tokens)[2]
        order = np.argsort(name)
        starts = runs(name[order])
        total = np.add.reduceat(n[order], starts[:-1])
        often = total >= least
        first = order[starts[:-1][often]]
        tokens = [t[first] for t in tokens]
        suffix, context, name = _names_of(tokens)
        found = [context, tokens[-1], suffix, mix(np.zeros(len(first), np.uint64), tokens[0]), name]
        return pa.table([*(pa.array(x.view(np.int64)) for x in found), pa.array(total[often])], ["context", "token", "suffix", "last", "name", "n"])

    dealt = chunks.select(*CHUNK).mapInArrow(deal, "shard long, grams binary")
    return dealt.groupBy("shard").applyInArrow(add, "context long, token long, suffix long, last long, name long, n long")


@dataclass
class Table:
    """A level: states (context, last, rest, c), grams (context, token, last, name, n, rest, c, p, ratio: p against the root) and bitmaps of both."""

    states: DataFrame
    grams: DataFrame
    maps: tuple[Bitmap, Bitmap]


def grow_tables(chunks: DataFrame, words: np.ndarray, counts: DataFrame, unit: float, least: int, shards: int) -> list[Table]:
    """The tree's levels as tables. ``counts`` (name, c) are those of single tokens, ``unit`` what they are divided by."""
    spark = chunks.sparkSession
    levels: list[Table] = []
    for depth in range(1, DEPTH + 1):
        path = scratch_path(spark, "suffix-grams")
        counted = _count_grams(chunks, words, depth, [x.maps for x in levels], least, shards)
        counted.write.option("compression", "zstd").parquet(path)
        grams = spark.read.schema(counted.schema).parquet(path)
        if depth == 1:
            root = counts.select(F.col("name").alias("token"), ((F.col("c") + 1.0) / unit).alias("below"), ((F.col("c") + 1.0) / unit).alias("root"))
            known = grams.filter("token != 0").drop("suffix").join(root, "token")
        else:
            shorter = levels[-1].grams.select(F.col("context").alias("suffix"), "token", F.col("p").alias("below"), (F.col("p") / F.col("ratio")).alias("root"))
            known = grams.filter("token != 0").join(shorter, ["suffix", "token"]).drop("suffix")
        totals = grams.filter("token = 0").select("context", F.col("n").cast("double").alias("c"))
        # the join deals by context already, so what follows moves no row
        by = Window.partitionBy("context")
        rest = (F.col("c") - F.col("listed") + PRIOR) / (F.col("c") + PRIOR)
        p = F.col("n") / (F.col("c") + PRIOR) + F.col("rest") * F.col("below")
        gain = F.sum(F.col("n") * F.log(F.col("p") / F.col("below"))).over(by) + (F.col("c") - F.col("listed")) * F.log("rest")
        gained = known.join(totals, "context").withColumn("listed", F.sum("n").over(by)).withColumn("rest", rest).withColumn("p", p).withColumn("gain", gain)
        kept = gained.filter((F.col("gain") >= MIN_EVIDENCE) & (F.col("gain") >= MIN_DIVERGENCE * F.col("c")))
        kept = stage(kept.select("context", "token", "last", "name", "n", "rest", "c", "p", (F.col("p") / F.col("root")).alias("ratio")), "suffix-kept")
        if kept.isEmpty():
            break
        states = kept.groupBy("context").agg(*(F.first(x).alias(x) for x in ("last", "rest", "c")))
        states = stage(states, "suffix-states")
        levels.append(Table(states, kept, (bitmap(states, "context"), bitmap(grams.filter("token != 0"), "name"))))
        clear_scratch(spark, path)
    return levels


def _shards(docs: DataFrame, tokens: int) -> int:
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards_for(tokens, SHARD_PLACES))


# --- scoring --------------------------------------------------------------------------


@dataclass
class Head:
    """Names and values, as log10, of the most frequent states or grams of all levels, and a bitmap of the others, if any."""

    index: Index
    values: np.ndarray
    others: Bitmap | None

    def look(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where names stand, whether they do, and whether a table must be asked instead."""
        at, known = self.index.find(names)
        if self.others is None:
            return at, known, np.zeros(len(names), bool)
        return at, known, ~known & self.others.may_have(names)


def _head_nodes(nodes: DataFrame) -> tuple[Head, Head]:
    """Of ``nodes`` (kind, name, value, c), the heads of the states, whose kinds are even, and of the grams."""
    cut = head_cut(nodes, HEAD_NODES)
    often = nodes.filter(_steps_of_count() >= cut).select("kind", "name", "value").toArrow()
    kind, name, value = (often.column(k).to_numpy() for k in ("kind", "name", "value"))
    heads = []
    for odd in (0, 1):
        own = kind % 2 == odd
        names, values = name[own].view(np.uint64), value[own]
        order = np.argsort(names)
        others = bitmap(nodes.filter((_steps_of_count() < cut) & (F.col("kind") % 2 == odd)), "name") if cut else None
        heads.append(Head(Index(names[order]), values[order], others))
    return heads[0], heads[1]


def _factors(chunks: DataFrame, words: np.ndarray, levels: list[Table], counts: DataFrame, tokens: int, shards: int) -> DataFrame:
    """row, gain: the sum of the tree's factors over the places of each text, as log10."""
    share = max(1, tokens // shards)
    # at most about as many last tokens as there are shards have more than a shard's share
    heavy = counts.filter(F.col("c") > share).select("name", F.least(F.lit(shards), F.ceil(F.col("c") / share)).cast("long").alias("copies")).toPandas()
    last_names = mix(np.zeros(len(heavy), np.uint64), heavy["name"].to_numpy(np.int64).view(np.uint64))
    order = np.argsort(last_names)
    last_names, copies = last_names[order], heavy["copies"].to_numpy(np.int64)[order]
    parts = None
    for depth, level in enumerate(levels, 1):
        states = level.states.select("last", F.lit(2 * depth).alias("kind"), F.col("context").alias("name"), F.log10("rest").alias("value"), "c")
        grams = level.grams.select("last", F.lit(2 * depth + 1).alias("kind"), "name", F.log10("ratio").alias("value"), F.col("n").cast("double").alias("c"))
        both = states.union(grams)
        parts = both if parts is None else parts.union(both)
    head_states, head_grams = _head_nodes(parts)
    maps = [x.maps[0] for x in levels]

    def copies_of(last: np.ndarray) -> np.ndarray:
        at, known = within(last_names, last)
        return np.where(known, copies[at], 1) if len(copies) else np.ones(len(last), np.int64)

    def known_factors(token: np.ndarray, at: np.ndarray, since: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Factors of places by the heads alone, and whether they are sure."""
        factor, sure = np.zeros(len(at)), np.ones(len(at), bool)
        open_, context = np.arange(len(at)), np.zeros(len(at), np.uint64)
        for depth, states in enumerate(maps, 1):
            longer = since[at[open_]] >= depth
            open_ = open_[longer]
            context = mix(context[longer], token[at[open_] - depth])
            able = states.may_have(context)
            open_, context = open_[able], context[able]
            where, known, ask = head_states.look(context)
            sure[open_[ask]] = False
            open_, context = open_[known], context[known]
            factor[open_] += head_states.values[where[known]]
            where, known, ask = head_grams.look(mix(context, token[at[open_]]))
            factor[open_[known]] = head_grams.values[where[known]]
            sure[open_[ask]] = False
            open_, context = open_[sure[open_]], context[sure[open_]]
        return factor, sure

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, ranks, names, codes, text, since, _ in _chunks(batches, words):
            token = names[codes]
            at = np.flatnonzero(since >= 1)
            at = at[maps[0].may_have(mix(np.zeros(len(names), np.uint64), names))[codes[at - 1]]]
            factor, sure = known_factors(token, at, since)
            gains = np.bincount(text[at[sure]], factor[sure], len(ids)).tobytes()
            # what is known of the chunk passes a shard as it is
            yield pa.RecordBatch.from_arrays([pa.array([chunk % shards]), pa.array([chunk]), pa.nulls(1, pa.binary()), pa.array([gains])], PLACES)
            at = at[~sure]
            last = _contexts(token, at, 1)
            near = [codes[at], codes[at - 1]]
            able = np.ones(len(at), bool)
            for depth, states in enumerate(maps[1:], 2):
                able[able] = since[at[able]] >= depth
                able[able] = states.may_have(_contexts(token, at[able], depth))
                near.append(np.where(able, codes[at - depth], 0))
            numbers = np.arange(len(ids), dtype=np.int32)
            shard = ((last % np.uint64(shards)).astype(np.int64) + at % copies_of(last)) % shards
            for k, part in _cut(shard, shards):
                raw = packed((numbers, text[at[part]]), *((ranks, x[part]) for x in near))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([chunk]), pa.array([raw]), pa.nulls(1, pa.binary())], PLACES)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = np.asarray(batch.column(0)).view(np.uint64)
            times = copies_of(last)
            row = np.repeat(np.arange(len(last)), times)
            shift = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            shard = ((last % np.uint64(shards)).astype(np.int64)[row] + shift) % shards
            yield pa.RecordBatch.from_arrays([pa.array(shard), *(c.take(pa.array(row)) for c in batch.columns[1:])], ["shard", "kind", "name", "value"])

    tree = parts.drop("c").mapInArrow(copy, "shard long, kind int, name long, value double")
    places = chunks.select(*CHUNK).mapInArrow(deal, "shard long, chunk long, places binary, gains binary")
    depths = len(levels)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        kind, name = right.column("kind").to_numpy(), right.column("name").to_numpy().view(np.uint64)
        value = right.column("value").to_numpy()
        found = {}
        for k in range(2, 2 * depths + 2):
            own = np.flatnonzero(kind == k)
            own = own[np.argsort(name[own])]
            found[k] = Index(name[own]), value[own]
        chunk, gains = left.column("chunk").to_pylist(), []
        for raw, known_ in zip(left.column("places").to_pylist(), left.column("gains").to_pylist(), strict=True):
            if raw is None:
                gains.append(np.arange(len(known_) // 8, dtype=np.int32).tobytes() + known_)
                continue
            (texts_, text), *columns = unpacked(raw)
            columns = [(named(v, words), codes) for v, codes in columns]
            token, *near = (values[codes] for values, codes in columns)
            factor = np.zeros(len(text))
            open_, context = np.arange(len(text)), np.zeros(len(text), np.uint64)
            for depth in range(1, depths + 1):
                states, rest = found[2 * depth]
                if depth == 1:
                    # single tokens are looked up once for each of their kinds
                    kinds, codes = columns[1]
                    one = mix(np.zeros(len(kinds), np.uint64), kinds)
                    at, known = (x[codes] for x in states.find(one))
                    context = one[codes]
                else:
                    context = mix(context, near[depth - 1][open_])
                    at, known = states.find(context)
                open_, context, at = open_[known], context[known], at[known]
                if not len(open_):
                    break
                factor[open_] += rest[at]
                grams, ratio = found[2 * depth + 1]
                at, seen = grams.find(mix(context, token[open_]))
                factor[open_[seen]] = ratio[at[seen]]
                longer = near[depth - 1][open_] != START
                open_, context = open_[longer], context[longer]
            gains.append(texts_.tobytes() + np.bincount(text, factor, len(texts_)).tobytes())
        return pa.table([pa.array(chunk, pa.int64()), pa.array(gains, pa.binary())], ["chunk", "gains"])

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.frombuffer(right.column("ids")[0].as_py(), np.int64)
        total = np.zeros(len(ids))
        for raw in left.column("gains").to_pylist():
            n = len(raw) // 12
            total[np.frombuffer(raw, np.int32, n)] += np.frombuffer(raw, np.float64, n, 4 * n)
        return pa.table([pa.array(ids), pa.array(total)], ["row", "gain"])

    gains = places.groupBy("shard").cogroup(tree.groupBy("shard")).applyInArrow(look, "chunk long, gains binary")
    return gains.groupBy("chunk").cogroup(chunks.select("chunk", "ids").groupBy("chunk")).applyInArrow(add, "row long, gain double")


def _steps_of_count():
    """A word's count on a scale of 64 steps a doubling."""
    return F.floor(F.log2("c") * 64)


def head_cut(counted: DataFrame, most: int) -> int:
    """The least step of counts from which on there are at most ``most`` rows; a row per step is fetched."""
    sizes = counted.groupBy(_steps_of_count().alias("step")).count().collect()
    rows = 0
    for step, n in sorted(map(tuple, sizes), reverse=True):
        rows += n
        if rows > most:
            return step + 1
    return 0


def score_documents(docs: DataFrame, training: str) -> DataFrame:
    """doc_id, ``training``, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``training`` names a boolean column: true for rows to learn from, false or null for others.
    Texts are lower-cased (A-Z); tokens are the words and one end. base_score is the log10
    probability by add-one counts of single tokens, score that by the tree. A null or empty text
    is the end alone. Repeated rows are learned from and scored each; doc_id may be null, and
    further columns of ``docs`` are left out. Without any row to learn from, all tokens have
    probability 1.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(training), F.lit(False)).alias("learn"))
    learned = rows.filter("learn")
    with shuffles_removed(docs.sparkSession):
        counted = stage(count_words(learned), "word-counts")
    n_texts = learned.count()
    n_words, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    train_tokens, kinds = n_words + n_texts, distinct + bool(n_texts)
    cut = head_cut(counted, HEAD_WORDS)
    frequent = counted.filter(_steps_of_count() >= cut).select("word", "name", "c").toArrow().sort_by([("c", "descending")])
    head = frequent["word"].cast(pa.large_string()).combine_chunks()
    head_counts = np.append(frequent["c"].to_numpy(), 0)
    ranked = np.append([NOTHING, START, END], frequent["name"].to_numpy().view(np.uint64))
    unit = float(np.log10(train_tokens + kinds + 1))
    start, end = (F.lit(int(x.view(np.int64))) for x in (START, END))
    ends = docs.sparkSession.range(0, 2, 1, 1).select(F.when(F.col("id") == 0, start).otherwise(end).alias("name"), F.lit(n_texts).cast("long").alias("c"))
    counts = counted.select("name", "c").union(ends)
    often = bitmap(counts.filter(F.col("c") >= MIN_COUNT), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, first = TaskContext.get().partitionId() << 32, TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high, row, codes, words in word_chunks(batch.column(1)):
                n, size = high - low, max(1, len(words))
                learn = batch.column(2).slice(low, n)
                ids = np.arange(first, first + n)
                rank = np.asarray(pc.fill_null(pc.index_in(words, head), len(head))).astype(np.int64)
                c = head_counts[rank]
                known = c > 0
                pairs, times = np.unique((row * size + codes)[~known[codes]], return_counts=True)
                bounds = np.searchsorted(pairs // size, np.arange(n + 1)).astype(np.int32)
                rare = words.take(pa.array(pairs % size)).cast(pa.string())
                own = [
                    batch.column(0).slice(low, n),
                    learn,
                    pa.array(ids),
                    pa.array(np.bincount(row, minlength=n)),
                    pa.array(np.bincount(row, known[codes], n).astype(np.int64)),
                    pa.array(np.bincount(row, np.log10(c + 1.0)[codes], n)),
                    pa.ListArray.from_arrays(pa.array(bounds), rare),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(times)),
                ]
                token, text, _ = sequences(n, row, codes, len(words))
                names = np.append(word_names(words), [START, END])
                ranks = np.append(np.where(known, (rank + 3).astype(np.uint64), names[:-2]), np.array([1, 2], np.uint64))
                ranks[~often.may_have(names)] = NOTHING
                whole = _chunk_row(chunk, ranks, token, text, ids, learn.to_numpy(zero_copy_only=False))
                fields = ["doc_id", "learn", "row", "n_words", "n_head", "head_sum", "rare", "times", "chunk", "n", "tokens", "ids", "sizes", "learns"]
                yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(n, x.type) for x in whole)], fields)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, x.type) for x in own), *whole], fields)
                chunk, first = chunk + 1, first + n

    schema = "doc_id long, learn boolean, row long, n_words long, n_head long, head_sum double, rare array<string>, times array<long>, "
    both = stage(rows.select("doc_id", "text", "learn").mapInArrow(run, schema + CHUNK_SCHEMA), "document-words")
    parts = both.filter("chunk IS NULL").select("doc_id", "learn", "row", "n_words", "n_head", "head_sum", "rare", "times")
    chunks = both.filter("chunk IS NOT NULL").select("n", *CHUNK)
    tail = parts.select("row", F.inline(F.arrays_zip("rare", "times"))).withColumnRenamed("rare", "word")
    found = (
        tail.join(counted.filter(_steps_of_count() < cut), "word")
        .groupBy("row")
        .agg(F.sum("times").alias("n_tail"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("tail_sum"))
    )
    gains = _gains(chunks, ranked, counts, n_texts, train_tokens, kinds)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    base = F.col("head_sum") + zero("tail_sum") + float(np.log10(n_texts + 1)) - (F.col("n_words") + 1) * unit
    return parts.drop("rare", "times").join(found, "row", "left").join(gains, "row", "left").select(
        "doc_id",
        F.col("learn").alias(training),
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_head") + zero("n_tail") + int(bool(n_texts))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + zero("gain")).alias("score"),
    )


def _gains(chunks: DataFrame, words: np.ndarray, counts: DataFrame, n_texts: int, train_tokens: int, kinds: int) -> DataFrame:
    """row, gain: what the tree adds to the score of each text."""
    spark = chunks.sparkSession
    nothing = spark.range(0).select(F.col("id").alias("row"), F.lit(0.0).alias("gain"))
    if not n_texts:
        return nothing
    places = chunks.agg(F.sum("n")).first()[0]
    shards = _shards(chunks, places)
    with shuffles_removed(spark):
        levels = grow_tables(chunks, words, counts.filter(F.col("c") >= MIN_COUNT), float(train_tokens + kinds + 1), MIN_COUNT, shards)
    return _factors(chunks, words, levels, counts, train_tokens, shards) if levels else nothing
