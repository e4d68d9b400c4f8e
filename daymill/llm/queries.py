"""One query per operator, at production parameters, over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import chat, clustering, compression, decontaminate, isolation, line_dedup, mixing, oracles, packing, simhash_groups, subword, suffix_array, suffix_model, token_stream
from daymill.llm.common import fold_of
from daymill.llm.tokenize import read_tokenizer

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
#: DuckDB SQL of those queries that SQL can express on whole tables.
ORACLES: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


def byte_bpe() -> str:
    import public_tokenizers

    return read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_rans_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_stream.write_and_describe(table(spark, sf_dir, "documents"), byte_bpe(), end_id=2)


@query
def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("training", fold_of("doc_id", 7) != 2)
    scored = suffix_model.score_documents(docs, "training")
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op4_cuckoo_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), keyed AS (
    SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
    SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), judged AS (
    SELECT keyed.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query
def op5_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = table(spark, sf_dir, "labels").filter(fold_of("doc_id", 3) != 1)
    scored = subword.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), learned)
    return scored.select("row.doc_id", "score", "predicted").select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op6_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_prefix_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.expand(turns.union(added))).drop("trainable")


ORACLES["op7_prefix_expansion"] = oracles.CHATS


@query
def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash_groups.group_documents(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_bucket_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


ORACLES["op9_bucket_pointers"] = oracles.REPEATS


@query
def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe(), capacity=1024, end_id=2)


@query
def op11_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"), "embedding", dim=64, k=16, rounds=3, scale=64, seed="1")


ORACLES["op11_heap_clusters"] = oracles.CLUSTERS


@query
def op12_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.copies(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op12_systematic_mix"] = oracles.MIXED


@query
def op13_norm_of_sum_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compress(table(spark, sf_dir, "embeddings"), "embedding", parts=4, entries=256, rounds=4, scale=1024)


ORACLES["op13_norm_of_sum_codes"] = oracles.CODES
