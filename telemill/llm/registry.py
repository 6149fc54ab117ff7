"""The operators as named queries over the tables of a data folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.llm import hard_negatives, hmm, host_rules, mixing, near_vectors, ngram_join, packing, prefix_trie, quality, substrings, token_store, warc, winnowing
from telemill.sources.scratch import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL = {
    "op1_ngram_jaccard": ngram_join.SQL,
    "op2_binary_codes": near_vectors.SQL,
    "op4_substring_dedup": substrings.SQL,
    "op7_warc": warc.SQL,
    "op8_host_rules": host_rules.SQL,
    "op9_mixing": mixing.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op1_ngram_jaccard(spark, d):
    return ngram_join.jaccard_components(table(spark, d, "documents"), size=3, percent=90).drop("text_hash", "first")


@query
def op2_binary_codes(spark, d):
    return near_vectors.near_duplicates(table(spark, d, "embeddings"))


@query
def op3_compression_quality(spark, d):
    return quality.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op4_substring_dedup(spark, d):
    return substrings.removal_digests(table(spark, d, "documents"))


@query
def op5_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query
def op6_hidden_markov(spark, d):
    return hmm.scores(table(spark, d, "documents"))


@query
def op7_warc(spark, d):
    return warc.round_trip(spark, table(spark, d, "pages")).drop("target_uri", "payload", "record_id", "refers_to_id")


@query
def op8_host_rules(spark, d):
    return host_rules.host_rules(table(spark, d, "documents"))


@query
def op9_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents")).drop("by_lap")


@query
def op10_token_orc(spark, d, tokenizer_path: str | None = None):
    import public_tokenizers

    path = scratch_dir(spark, "tokens")
    tokenizer_path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    token_store.write_tokens(table(spark, d, "documents"), path, tokenizer_path, end_id=2)
    return token_store.token_digests(spark, path)


@query
def op11_hard_negatives(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, d, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, anchor=F.col("vec_id") % 50 == 0)


@query
def op12_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(table(spark, d, "conversations"), graft=prefix_trie.GRAFT)


@query
def op13_winnowing(spark, d):
    return winnowing.edited_likeness(table(spark, d, "documents"))
