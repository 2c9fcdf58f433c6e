"""A corpus from raw documents: filtered, deduplicated, cleaned, mixed and encoded.

Each stage works on what its predecessor kept, read back from Parquet. All but the last
return the columns of ``documents``. Every stage decides on each row by itself: rows that
share a doc_id, or have none, are documents like others (labels hold for all rows of an
id). A null or empty text fails the quality rules; an empty table gives an empty one;
further columns are kept, whatever their names, and long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.chosen_path import one_of_each
from tripmart.llm.common import small_batches, stored
from tripmart.llm.mixing import mixed_documents
from tripmart.llm.quality import good_documents
from tripmart.llm.rank_bpe import encode_documents
from tripmart.llm.skip_chain import masked_documents

VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; trusted are those labelled of good quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, labels.where(F.col("quality") == 1))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, 80 percent."""
    small_batches(spark)
    return one_of_each(docs, size=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    small_batches(spark)
    return masked_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the mix takes of a document."""
    return mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each row's ids and decoded text."""
    small_batches(spark)
    return encode_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", bpe_encoding),
]

# Hashed n-grams, trained weights and token merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
