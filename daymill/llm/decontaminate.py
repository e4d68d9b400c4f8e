"""Benchmark decontamination by SimHash over item-sized windows, on DataFrame functions only.

Documents and items are lower-cased and cut into five-word shingles (a text of fewer words is
one shingle). Windows are as many words long as some item and begin at any word; a shorter document
is one window. A window can reach the similarity with an item of its size only if most of its shingles
are shingles of such items: of a window's m' and an item's m, 4/9 of (m + m') at least. So shingles
of items are looked up in all documents, and a window is formed at every place where enough of them
lie; everywhere else none can resemble an item. Where a shared shingle says that an item would begin
before the document or end after it, the window that is left of it is formed too. Each window gets a 64-bit SimHash; with 64 bits in
RADIUS + 1 blocks, any two fingerprints within RADIUS bits agree on one block whole, so looking
up every block among items of the window's size finds them all. Pairs within the radius are then
compared by their shingles themselves, each weighted with how often it occurs:
shared weight over all weight.

Equal texts are looked at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import SPACES, stage

SHINGLE = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 fingerprints differ in 9.7 of 64 bits, give or take 2.9.
RADIUS = 20
#: Shingles of items up to which they are broadcast (about 100 bytes each); beyond, they are shuffled.
BROADCAST_SEEDS = 500_000


def let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, not at every use inside ``then``."""
    return F.transform(F.array(value), then)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != "")


def grams(word_hashes: Column, k: int) -> Column:
    """Hashes of all runs of k words, none if there are fewer words."""
    at = F.sequence(F.lit(0), F.size(word_hashes) - k)
    run = F.transform(at, lambda i: F.xxhash64(*(F.get(word_hashes, i + j) for j in range(k))))
    return F.when(F.size(word_hashes) >= k, run).otherwise(F.array().cast("array<long>"))


def grams_of(k: int):
    return lambda word_hashes: grams(word_hashes, k)


def word_hashes(text: Column) -> Column:
    return let(words(text), lambda w: F.transform(w, lambda x: F.xxhash64(x)))


def weighted(shingles: Column) -> Column:
    """The shingles as a set in which the second, third, ... of equal ones have names of their own."""
    def numbered(s: Column) -> Column:
        def name(x, i):
            before = i + 1 - F.array_position(s, x)
            return F.when(before == 0, x).otherwise(F.xxhash64(x, before))

        return F.transform(s, name)

    again = F.size(F.array_distinct(shingles)) < F.size(shingles)
    return F.when(again, let(F.sort_array(shingles), numbered)).otherwise(shingles)


def simhash(shingles: Column) -> Column:
    """Bit b is set if it is set in more than half of the hashes."""
    def with_bit(found: Column, b: Column) -> Column:
        count = F.aggregate(
            shingles, F.lit(0), lambda n, x: n + F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(1)).cast("int")
        )
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), b)
        return F.when(2 * count > F.size(shingles), found.bitwiseOR(bit)).otherwise(found)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)


def blocks(fingerprint: Column) -> Column:
    """Number and bits of each of the RADIUS + 1 blocks."""
    cuts = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(
        *(
            F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("bits"))
            for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        )
    )


def _items(benchmark: DataFrame) -> DataFrame:
    hashed = benchmark.select("item_id", word_hashes(F.col("text")).alias("w")).filter(F.size("w") > 0)
    shingles = F.lit(None).cast("array<long>")
    for k in range(1, SHINGLE + 1):
        enough = F.size("w") == k if k < SHINGLE else F.size("w") >= k
        shingles = F.when(enough, grams(F.col("w"), k)).otherwise(shingles)
    parts = hashed.select("item_id", F.size("w").alias("n"), F.least(F.size("w"), F.lit(SHINGLE)).alias("k"), shingles.alias("s"))
    return parts.select("item_id", "n", "k", "s", weighted(F.col("s")).alias("set"), simhash(F.col("s")).alias("fp")).withColumn(
        "item", F.monotonically_increasing_id()
    )


def text_key(text: Column) -> tuple[Column, Column]:
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit("second"), whole).alias("k2")


def _shingles_of(n: Column) -> Column:
    """How many shingles n words have."""
    return n - F.least(n, F.lit(SHINGLE)) + 1


def _least_hits() -> Column:
    """Shingles that any window must share with an item of n words: 0.8 of the item's."""
    return F.expr(f"(4 * (n - least(n, {SHINGLE}) + 1) + 4) div 5")


def _starts() -> Column:
    """n, start and hits (and no ``said``) of all windows of n words with enough hits, from the sorted places ``at`` of the hits.

    A window belongs to the first hit in it. It has enough if the hit that completes the number lies in it too, so
    the windows of a hit begin in one interval.
    """
    least, reach = _least_hits(), _shingles_of(F.col("n")) - 1

    def of_hit(i: Column) -> Column:
        first, last = F.get("at", i), F.get("at", (i + least - 1).cast("int"))
        low = F.greatest(last - reach, F.coalesce(F.get("at", i - 1) + 1, last - reach))

        def counted(start: Column) -> Column:
            inside = F.filter(F.slice("at", i + 1, reach + 1), lambda p: p <= start + reach)
            return F.struct(F.col("n"), start.alias("start"), F.size(inside).alias("hits"), F.lit(False).alias("said"))

        return F.when(low <= first, F.transform(F.sequence(low, F.greatest(low, first)), counted))

    found = F.transform(F.sequence(F.lit(0), (F.size("at") - least).cast("int")), of_hit)
    return F.flatten(F.filter(found, lambda f: f.isNotNull()))


def _said() -> Column:
    """The starts that shared shingles say, as windows like those of ``_starts``; with all hits, since they lie anywhere."""
    return F.transform("said", lambda start: F.struct(F.col("n"), start.alias("start"), F.size("at").alias("hits"), F.lit(True).alias("said")))


def leaked_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k1, k2 (name of a text), item_id, similarity, start (first word), n_words of its most similar window."""
    items = stage(_items(benchmark), "benchmark-items")
    seeds = stage(items.select("k", "n", F.posexplode("s").alias("offset", "h")).distinct(), "benchmark-shingles")
    few = seeds.count() <= BROADCAST_SEEDS
    named = docs.select(*text_key(F.col("text")), F.coalesce("text", F.lit("")).alias("text"))
    hits = None
    for (k,) in seeds.select("k").distinct().collect():
        own = seeds.filter(F.col("k") == k).select("h", "n", "offset")
        found = (
            named.select("k1", "k2", F.posexplode(let(word_hashes(F.col("text")), grams_of(k))).alias("at", "h"))
            .join(F.broadcast(own) if few else own, "h")
            .select("k1", "k2", "n", "at", (F.col("at") - F.col("offset")).alias("start"))
        )
        hits = found if hits is None else hits.union(found)
    if hits is None:
        hits = named.select("k1", "k2", F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(0).alias("start")).filter("false")
    gathered = hits.groupBy("k1", "k2", "n").agg(F.sort_array(F.collect_set("at")).alias("at"), F.collect_set("start").alias("said"))
    starts = gathered.filter(F.size("at") >= _least_hits()).select("k1", "k2", F.concat(_starts(), _said()).alias("starts"))
    places = stage(starts.groupBy("k1", "k2").agg(F.flatten(F.collect_list("starts")).alias("places")), "benchmark-places")
    texts = named.join(places.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    hashed = texts.select("k1", "k2", word_hashes(F.col("text")).alias("w")).join(places, ["k1", "k2"])

    def sticks_out(p: Column) -> Column:
        return (p.start < 0) | (p.start + p.n > F.size("w"))

    def window(p: Column) -> Column:
        low = F.greatest(p.start, F.lit(0))
        high = F.least(p.start + p.n, F.size("w"))
        formed = ~p.said | sticks_out(p)
        return F.struct(p.n.alias("n"), low.alias("start"), (high - low).alias("n_words"), p.said.alias("said"), formed.alias("formed"), F.slice("w", low + 1, high - low).alias("w"))

    def can_reach(p: Column) -> Column:
        low, high = F.greatest(p.start, F.lit(0)), F.least(p.start + p.n, F.size("w"))
        enough = 9 * p.hits >= 4 * (2 * _shingles_of(p.n) - (p.n - (high - low)))
        return enough & (p.said | ~sticks_out(p) | (p.start == 0))

    name = ["k1", "k2", "n", "start", "n_words"]
    cut = hashed.select("k1", "k2", F.inline(F.transform(F.filter("places", can_reach), window)))
    cut = cut.groupBy(*name).agg(F.first("w").alias("w"), F.bool_or("said").alias("said"), F.bool_or("formed").alias("formed")).filter("formed")
    shingles = F.lit(None).cast("array<long>")
    for k in range(1, SHINGLE + 1):
        is_k = F.least(F.col("n_words"), F.col("n"), F.lit(SHINGLE)) == k
        shingles = F.when(is_k, grams(F.col("w"), k)).otherwise(shingles)
    windows = cut.select(*name, "said", shingles.alias("s"))
    windows = stage(
        windows.select(*name, "said", weighted(F.col("s")).alias("window_set"), simhash(F.col("s")).alias("window_fp")),
        "benchmark-windows",
    )
    pairs = (
        windows.select(*name, "window_fp", F.inline(blocks(F.col("window_fp"))))
        .join(items.select("item", "n", "fp", F.inline(blocks(F.col("fp")))), ["n", "block", "bits"])
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("window_fp"))) <= RADIUS)
        .select(*name, "item")
        .distinct()
    )
    shared = F.size(F.array_intersect("window_set", "set"))
    similarity = shared / (F.size("window_set") + F.size("set") - shared)
    return (
        pairs.join(windows.drop("window_fp"), name)
        .join(items.select("item", "item_id", "set"), "item")
        .withColumn("similarity", similarity)
        .filter(F.col("similarity") >= SIMILARITY)
        .groupBy("k1", "k2", "item_id")
        .agg(F.max(F.struct("similarity", "said", (-F.col("start")).alias("back"), "n_words")).alias("best"))
        .select("k1", "k2", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.n_words")
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start, n_words: every item that a document holds, with the most similar window.

    Ties go to windows that begin where a shared shingle says, then to the first. A null or empty text, and an item without words, hold nothing.
    Rows without doc_id and repeated rows are judged like others, a pair of ids is named once.
    Further columns are not carried.
    """
    found = stage(leaked_texts(docs, benchmark), "benchmark-leaks")
    named = docs.select("doc_id", *text_key(F.col("text")))
    return (
        named.join(found, ["k1", "k2"])
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best"))
        .select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.n_words")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    found = stage(leaked_texts(docs, benchmark).select("k1", "k2").distinct(), "benchmark-leaks")
    k1, k2 = text_key(docs["text"])
    rows = docs.select(F.struct(*docs.columns).alias("row"), k1, k2)
    return rows.join(found, ["k1", "k2"], "left_anti").select("row.*")
