"""The registered queries of the training-data operators, with their DuckDB SQL.

Each applies its operator to the whole of its table and derives the columns
of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight.llm import (
    decontamination,
    embedding_dedup,
    filter_audit,
    fingerprint,
    lexical_search,
    lm_scoring,
    mixing,
    pii,
    sentencepiece_codec,
    sharding,
    simhash,
    token_count,
    toxicity,
)
from cardsight.llm.common import table

#: Tokenizer files of the contracts, and the limit of op4.
SENTENCEPIECE_MODEL = "piece_bpe_32k.model"
COUNTING_TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "labels").where("quality = 1")
    scores = lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), targets)
    rounded = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")]
    return scores.select(F.col("id").alias("doc_id"), "n_tokens", *rounded)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=8)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(SENTENCEPIECE_MODEL)
    encoded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), path)
    return sentencepiece_codec.digest(sentencepiece_codec.decode(encoded, path))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(COUNTING_TOKENIZER)
    counts = token_count.count_tokens(table(spark, sf_dir, "documents"), path)
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"), n_shards=8)
    taken = (F.col("size") * F.size("copies")).cast("long")
    shards = F.array_join(F.transform("copies", lambda c: c["shard"].cast("string")), ",")  # in the order of epochs
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), shards.alias("shards")
    )


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels).withColumnRenamed("id", "doc_id")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return embedding_dedup.near_duplicates(vectors).withColumnRenamed("id", "vec_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, k=20).withColumnRenamed("id", "doc_id")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(docs, items, window=10).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """Queries that SQL can express; the others are tested against brute force in ``tests/llm``."""
    return {
        "op1_lm_scoring": lm_scoring.ORACLE_SQL,
        "op2_sharding": sharding.ORACLE_SQL,
        "op5_mixing": mixing.ORACLE_SQL,
        "op11_lexical_search": lexical_search.ORACLE_SQL,
        "op12_filter_audit": filter_audit.ORACLE_SQL,
        "op13_decontamination": decontamination.ORACLE_SQL,
    }
