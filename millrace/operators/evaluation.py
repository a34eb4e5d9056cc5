"""Gold sets and retrieval scores."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.jobs import Jobs
from millrace.sources.sinks import write_csv

MIN_GOLD_CHARS, SEED = 150, 42


def gold_sample(chunks: DataFrame, n: int = 300, *, id_col: str = "chunk_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``n`` long chunks in the order of a seeded hash: the same draw on every run and at any partitioning."""
    order = F.sha2(F.concat(F.col(id_col), F.lit(str(seed))), 256)
    return chunks.filter(F.length(text_col) > MIN_GOLD_CHARS).orderBy(order, id_col).limit(n)


def excerpt_question(text: str) -> str:
    """A stand-in for a question writer: the text's first twelve words."""
    return " ".join(text.split()[:12])


def gold_questions(sample: DataFrame, write: Callable[[str], str] = excerpt_question) -> DataFrame:
    """``question, gold_chunk_id, gold_parent_id``."""

    @F.pandas_udf("string")
    def ask(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(write)

    return sample.select(ask("text").alias("question"), F.col("chunk_id").alias("gold_chunk_id"), F.col("parent_id").alias("gold_parent_id"))


def first_relevant(hits: DataFrame, queries: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """``query_id, rank`` of every query; ``hits(query_id, rank, relevant)``; null where no hit is relevant."""
    found = hits.filter("relevant").groupBy(query_id).agg(F.min("rank").alias("rank"))
    return queries.select(query_id).join(found, query_id, "left")


def scores(ranks: DataFrame, k: int, *labels: str) -> DataFrame:
    """``k, n, recall_at_k, mrr`` rounded to 3 places; a rank beyond ``k`` is a miss."""
    hit = F.coalesce(F.col("rank") <= k, F.lit(False))
    out = ranks.groupBy(*labels).agg(F.count("*").alias("n"), F.round(F.avg(hit.cast("double")), 3).alias("recall_at_k"), F.round(F.avg(F.when(hit, 1 / F.col("rank")).otherwise(0.0)), 3).alias("mrr"))
    return out.select(*labels, F.lit(k).alias("k"), "n", "recall_at_k", "mrr")


def evaluate(hits: DataFrame, gold: DataFrame, table: str, k: int = 5) -> DataFrame:
    """One row of scores; a hit counts by its parent, and not at all where ``parent_asin`` is null."""
    judged = hits.join(gold.select("query_id", "gold_parent_id"), "query_id")
    relevant = F.col("parent_asin").isNotNull() & (F.split_part("id", F.lit("-"), F.lit(1)) == F.col("gold_parent_id"))
    return scores(first_relevant(judged.withColumn("relevant", relevant), gold), k).select(F.lit(table).alias("table"), "*")


def run_evaluation(jobs: Jobs, tables: dict[str, Callable[[DataFrame], DataFrame]], gold: DataFrame, path: str, *, k: int = 5) -> DataFrame:
    """A row of scores per table, written as CSV, as the job ``eval:retrieval``.

    ``tables``: name -> a retriever that takes the gold questions and gives hits (``query_id, id, rank, parent_asin``).
    """
    with jobs.job("eval:retrieval") as job:
        rows = [evaluate(retrieve(gold), gold, name, k) for name, retrieve in tables.items()]
        found = functools.reduce(DataFrame.unionByName, rows)
        write_csv(found, path)
        job["records_in"] = job["records_out"] = len(rows)
    return found
