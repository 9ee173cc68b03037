"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footings.llm import (ann, bpe, chat, collocations, decontamination, fingerprints, mixing, orderminhash, quality,
                          secrets, sharding, spelling, tokencounts)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


CONTEXT = 512


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers are read from the stored counts: the last one, and the longest prefix that fits the context."""
    stored = tokencounts.prefix_counts(_table(spark, sf_dir, "documents"), _tokenizer())
    counts = F.col("counts")
    n_tokens = tokencounts.tokens_of_prefix(counts, F.size(counts) - 1)
    return stored.select("doc_id", "n_bytes", n_tokens.cast("bigint").alias("n_tokens"), (n_tokens > CONTEXT).alias("over_limit"),
                         tokencounts.longest_within(counts, CONTEXT).cast("bigint").alias("chars_within_limit"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode what was encoded, and digest both."""
    encoded = bpe.encode(docs, _tokenizer())
    both = bpe.decode(encoded, _tokenizer())
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", chat.EXTRA_TEXT), (-7, 1, "assistant", chat.EXTRA_TEXT)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return chat.chat_digests(chat.format_chats(turns.unionByName(extra)))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(_table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), 10)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), sharding.QUERY_BYTES)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digests(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_secret_scans": op5_secret_scans,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_decontamination": op11_decontamination,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op4_chat_formatting": chat.SQL,
    "op7_sharding": sharding.SQL,
    "op8_mixing": mixing.SQL,
    "op11_decontamination": decontamination.SQL,
    "op12_collocations": collocations.SQL,
    "op13_spelling_variants": spelling.SQL,
}
