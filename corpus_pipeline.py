"""From raw documents to packed token sequences, by the operators of ``millrace.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents, ``n_chars`` counted anew where the text has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import drop_staged, staged, table
from millrace.llm.mixing import mixed_documents
from millrace.llm.ngram_join import drop_near_copies
from millrace.llm.packing import pack
from millrace.llm.quality import keep_quality
from millrace.llm.queries import TOKENIZER, label_quality
from millrace.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's thresholds go."""
    return keep_quality(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of five-word shingle similarity 0.8 or more, the document of the smallest id stays."""
    return drop_near_copies(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 200-byte string that starts anywhere else go from the texts; documents stay."""
    return remove_repeats(docs, length=200).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of each source in part."""
    return mixed_documents(docs, quality=label_quality(spark, sf_dir)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 4096 tokens."""
    return pack(docs, TOKENIZER).withColumnRenamed("id", "doc_id")


STAGES = [("quality_rules", quality_rules), ("ngram_join", ngram_join), ("suffix_dedup", suffix_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the stages on word shingles, suffixes and token ids; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        if i:
            drop_staged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
