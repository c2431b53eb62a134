"""The corpus pipeline: from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet under the shared folder and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``.

1. ``toxicity`` learns from ``labels`` and drops documents scored 0.5 or more;
   documents without text stay.
2. ``simhash_near_dedup`` keeps one document of each group of near copies (4-word
   shingles, at most 4 bits apart), that of the smallest id.
3. ``pii`` replaces personal data by its kind in brackets and counts the
   characters anew.
4. ``mixing`` brings the sources to their target weights: documents are left
   out or repeated, at most three times, and dealt to shards.
5. ``sentencepiece`` encodes each row and decodes it again: number and
   checksum of the ids, checksum of the decoded text.

Empty tables pass through every stage; null texts, ids and sources follow the
rules in each operator's module; columns beyond those of ``documents`` are
kept to the fourth stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardsight.llm import mixing, pii, sentencepiece_codec, simhash, toxicity
from cardsight.llm.common import stored, table

SENTENCEPIECE_MODEL = "piece_bpe_32k.model"
N_SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs, shingle=4, max_bits=4)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, n_shards=N_SHARDS)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(SENTENCEPIECE_MODEL)
    return sentencepiece_codec.digest(sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_and_decode),
]

#: Classifier, fingerprints and token ids have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
