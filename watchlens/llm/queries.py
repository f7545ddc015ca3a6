"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchlens.llm import (
    bpe, cotrain, decontaminate, lattice, middles, mixing, packing, prefix_trie, rules, rules_sql, secret_crf, shards, simhash, toxicity, trie_sql,
)
from watchlens.llm.text import documents, remainder
from watchlens.session import materialize

SHARDS = 24
TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
PACKED_TOKENIZER, END_ID, SEQUENCE_IDS = "word_bpe_49k.json", 1, 2048


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder))


def op2_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op3_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, folder).withColumn("held_out", remainder(F.col("doc_id"), 5) == 1)
    return lattice.scores(docs, "held_out", lattice.load_vocabulary(public_tokenizers.path(TOKENIZER)))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    counts = bpe.token_counts(documents(spark, folder), bpe.load_ranks(public_tokenizers.path(TOKENIZER)))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    lexicon = toxicity.learn(docs, labels(spark, folder).where(remainder(F.col("doc_id"), 5) != 0))
    return toxicity.scores(docs, lexicon).select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Trained without the labels of every fifth id, which show how it does."""
    docs = documents(spark, folder)
    model = cotrain.learn(docs, labels(spark, folder).where(remainder(F.col("doc_id"), 5) != 0))
    held_out = remainder(F.col("doc_id"), 5) == 0
    return cotrain.scores(docs, model).withColumns({"held_out": held_out, "kept": F.col("score") >= 0.5})


def op8_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return secret_crf.scan(docs, secret_crf.learn(docs))


def op9_shard_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = shards.shard_rows(documents(spark, folder), shards.equal_weights(SHARDS), shards.equal_weights(SHARDS + 1))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = packing.load_tokenizer(public_tokenizers.path(PACKED_TOKENIZER))
    return packing.pieces(packing.windows(documents(spark, folder), tokenizer, END_ID, SEQUENCE_IDS))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = middles.transform(documents(spark, folder))
    restored = middles.restore(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return prefix_trie.prefix_trie(prefix_trie.shared_heads(materialize(prefix_trie.conversations(turns), "conversation-paths")))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_benchmark_leaks": op2_benchmark_leaks,
    "op3_lattice_scores": op3_lattice_scores,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_near_copies": op8_near_copies,
    "op9_shard_records": op9_shard_records,
    "op10_secrets": op10_secrets,
    "op11_pack_sequences": op11_pack_sequences,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_trie": op13_conversation_trie,
}
#: The other operators hash, learn or search in ways that SQL does not have; their tests use brute force.
ORACLE: dict[str, str] = {
    "op4_quality_rules": rules_sql.SQL,
    "op12_fill_in_middle": trie_sql.MIDDLES,
    "op13_conversation_trie": trie_sql.TRIE,
}
