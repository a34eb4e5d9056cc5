"""The queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import oracles
from millrace.llm.annulus import cluster_vectors
from millrace.llm.chat import format_conversations, read_back
from millrace.llm.common import fresh_dir, table
from millrace.llm.mixing import mix
from millrace.llm.ngram_join import ngram_components
from millrace.llm.packing import pack
from millrace.llm.pivots import near_vectors
from millrace.llm.prefix_trie import prefix_trie
from millrace.llm.quality import quality_verdicts
from millrace.llm.sharding import shard_rows
from millrace.llm.suffix_dedup import removal_digests
from millrace.llm.token_store import document_digests, write_store
from millrace.llm.url_filter import url_verdicts
from millrace.llm.warc import read_warc, write_warc

#: Where the vocabulary file lies on driver and executors alike.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: Both turns of the extra conversation say this.
CONFLICT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(CONFLICT).alias("text")) for i, r in enumerate(("user", "assistant"))])))
    formatted = format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    back = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("conv").alias("conv_id"), "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


#: Words of unlabelled documents weigh half of those labelled good, and those labelled bad a quarter.
def label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality weights (doc_id, weight) from the labels table, over a base weight of 1 for the unlabelled."""
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), quality=label_quality(spark, sf_dir))
    return found.selectExpr("id as doc_id", "size", "source_size", "target", "taken")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.93).withColumnRenamed("id", "vec_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), 40).withColumnRenamed("id", "doc_id")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.selectExpr("id as doc_id", "n_shingles", "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"), length=200).withColumnRenamed("id", "doc_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_verdicts(table(spark, sf_dir, "documents"))
    return found.selectExpr("id as doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER).withColumnRenamed("id", "doc_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))
    back = read_warc(index)
    return back.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return document_digests(spark, path).withColumnRenamed("id", "doc_id")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"), 8, rounds=10, dims=64, scale=1024, seed=3).withColumnRenamed("id", "vec_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), head=6, every=100)


#: The rules that pages are judged by.
URL_RULES = "SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow') AS rules(host, path, verdict)"


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), spark.sql(URL_RULES)).withColumnRenamed("id", "page_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat_formatting, op2_mixing, op3_embedding_near_dedup, op4_sharding, op5_ngram_join, op6_suffix_dedup, op7_quality_rules, op8_packing, op9_warc, op10_token_store, op11_centroid_clustering, op12_prefix_trie, op13_url_filters)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
