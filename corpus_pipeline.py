"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

Language ID drops texts that it rejects, exact dedup keeps the best copy, SimHash
near-dedup keeps one document of each group, decontamination drops documents
that hold test items, and BPE encoding returns one row per document left.
A stage sees only what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsift.llm import bpe, decontam, dedup, langid, simhash
from logsift.llm.common import table
from logsift.llm.queries import tokenizer_file
from logsift.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known_languages(docs, langid.fit(langid.training_sample(docs)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs, words=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


#: Bytes of a block of texts: its tasks hold the block's words beside what earlier stages have left in the executors, so less
#: than by default, for more rows of words (a word has one in each block).
ENCODING_BLOCK = 16 << 20


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, tokenizer_file("word_bpe_49k.json").decode(), block_bytes=ENCODING_BLOCK)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: SQL cannot express the learned and hashed stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
