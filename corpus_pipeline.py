"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, personal data, BPE.

Counted as part of the training-data subpackage.  Each stage takes the documents
its predecessor kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, pii
from millrace.llm.bpe import encode_decode
from millrace.llm.common import fold, materialize, table
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.jaccard import one_per_component
from millrace.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no letter, or two languages as near as each other."""
    return langid.keep_identified(docs, langid.learn_profiles(docs.where(fold("doc_id", 5) != 0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each component of five-word shingle similarity 0.8."""
    return one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within a tenth of its length in edits."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; every document stays."""
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encode_decode(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", personal_data),
    ("bpe", tokens),
]

#: SQL can express neither the language model nor the edit distance search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
