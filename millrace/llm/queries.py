"""Queries and oracle SQL of the training-data operators, and how they register."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, quality, sql, toxicity
from .ann import nearest
from .bpe import encode_decode
from .common import fold, materialize, table
from .decontaminate import find_items
from .jaccard import jaccard_components
from .negatives import mine_negatives
from .pii import find_pii, pii_digest
from .ranked import rank_documents
from .token_files import tokenize_to_orc
from .urls import filter_urls


def tokenizer_path(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.learn(docs, labels.where(fold("doc_id", 4) != 2), "quality")
    return quality.score(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = langid.learn_profiles(docs.where(fold("doc_id", 5) != 0))
    return langid.identify(docs.select("doc_id", "text"), profiles).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.learn(docs, labels.where(fold("doc_id", 3) != 1), "toxic")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_to_orc(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(find_pii(table(spark, sf_dir, "documents", "doc_id", "text")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return mine_negatives(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


#: One more conversation, in another layout than the table's; its texts hold control strings.
CONTROL_ID, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.table_turns(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    record = json.dumps({"messages": [{"role": role, "content": CONTROL_TEXT} for role in ("user", "assistant")]})
    more = chat.record_turns(spark.createDataFrame([(CONTROL_ID, record)], "conv_id long, body string"), "conv_id", "body")
    return chat.read_digests(materialize(chat.format_turns(turns.unionByName(more)), "formatted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_quality, op2_language, op3_decontaminate, op4_toxicity, op5_jaccard_join, op6_token_files, op7_nearest, op8_bpe_roundtrip, op9_pii, op10_url_filter, op11_hard_negatives, op12_ranked_search, op13_chat_format)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op5_jaccard_join": sql.op5_jaccard_join(), "op10_url_filter": sql.op10_url_filter(), "op11_hard_negatives": sql.op11_hard_negatives(), "op12_ranked_search": sql.op12_ranked_search(), "op13_chat_format": sql.op13_chat_format()}
