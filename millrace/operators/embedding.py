"""Embedding behind a seam. The default is a deterministic stand-in by feature hashing, not a language model."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import enrich
from millrace.operators.chunking import chunk
from millrace.operators.cleaning import BATCH, batch_hashes, batched
from millrace.operators.jobs import Jobs
from millrace.schemas import EMBEDDING_DIM
from millrace.sources.sinks import write_parquet
from millrace.staging import BATCH_BYTES, staged


class Embedder(Protocol):
    dim: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashingEmbedder:
    """Words hashed to signed places by MD5, summed and brought to unit length (a text without words: the first axis)."""

    def __init__(self, dim: int = EMBEDDING_DIM):
        self.dim = dim
        self.places: dict[str, int] = {}

    def _place(self, word: str) -> int:
        """The word's place, from 1, with its sign."""
        if word not in self.places:
            if len(self.places) >= 100_000:
                self.places.clear()
            h = int(hashlib.md5(word.encode()).hexdigest()[:15], 16)  # noqa: S324
            self.places[word] = (h // 2 % self.dim + 1) * (1 if h % 2 else -1)
        return self.places[word]

    def embed(self, texts: list[str]) -> list[list[float]]:
        lists = [[self._place(w) for w in text.lower().split()] for text in texts]
        at = np.array([p for places in lists for p in places], np.int64)
        row = np.repeat(np.arange(len(texts)), [len(places) for places in lists])
        out = np.bincount(row * self.dim + np.abs(at) - 1, np.sign(at), minlength=len(texts) * self.dim).reshape(len(texts), self.dim)
        n = np.sqrt((out * out).sum(axis=1, keepdims=True))
        out[n[:, 0] == 0, 0] = 1
        return (out / np.where(n == 0, 1, n)).tolist()


def model_embedder(name: str, dim: int) -> Embedder:
    """A sentence encoder by name, loaded on each worker where its library is installed; the library's ImportError otherwise."""
    from sentence_transformers import SentenceTransformer

    class Model:
        def __init__(self) -> None:
            self.dim, self.model = dim, None

        def embed(self, texts: list[str]) -> list[list[float]]:
            self.model = self.model or SentenceTransformer(name)
            return self.model.encode(texts, normalize_embeddings=True).tolist()

    return Model()


def embed_chunks(reviews: DataFrame, strategy: str, embedder: Embedder, *, id_col: str = "id", metadata: tuple[str, ...] = ("rating", "asin", "parent_asin", "helpful_vote")) -> DataFrame:
    """Cleaned reviews -> ``chunk_id, parent_id, seq, text, embedding`` and their metadata.

    What is embedded names the product (``product_title``, else ``category``) before the text; what is stored is the bare text.
    """
    pieces = chunk(reviews, strategy, id_col=id_col)
    told = pieces.withColumn("__told", enrich(F.col("product_title"), F.col("category"), F.col("text")))
    return embed_column(told, embedder, text_col="__told").select("chunk_id", "parent_id", "seq", "text", "embedding", *metadata)


def run_embedding(jobs: Jobs, reviews: DataFrame, embedder: Embedder, path: str, *, strategy: str = "sentence", id_col: str = "id") -> DataFrame:
    """Chunk, enrich, embed and write, as the job ``embed:<strategy>``; returns what was written."""
    with jobs.job(f"embed:{strategy}") as job:
        write_parquet(embed_chunks(reviews, strategy, embedder, id_col=id_col), path)
        done = reviews.sparkSession.read.parquet(path)
        job["records_in"], job["records_out"] = reviews.count(), done.count()
    return done


#: Texts, and characters unless one text has more, that the encoder of a column is given at once.
TEXTS, CHARS = 256, 1 << 20


def slices(texts: list[str], most: int = TEXTS, chars: int = CHARS) -> Iterator[list[str]]:
    """Consecutive texts, as many at once as stay within both bounds."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if i > begin and (i - begin == most or held + len(text) > chars):
            yield texts[begin:i]
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield texts[begin:]


def embed_column(df: DataFrame, embedder: Embedder, *, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
    """Texts (null: empty) with their vectors.

    The session is set to send Python BATCH_BYTES at once: a batch's bound in rows alone would let
    long texts fill its memory. A batch is encoded in :func:`slices`, and of each single-precision
    arrays alone are kept.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            vectors: list[np.ndarray] = []
            for texts in slices(s.fillna("").tolist()):
                vectors.extend(np.asarray(embedder.embed(texts), np.float32))
            yield pd.Series(vectors, dtype=object)

    return df.withColumn(out_col, run(text_col))


def encode(batches: DataFrame, embedder: Embedder, *, order_col: str = "line_number", text_col: str = "text") -> DataFrame:
    """``embedding, error_type, error_message`` beside the rows of numbered batches; one call of the encoder a batch.

    A batch is the unit of failure: where the encoder fails, all of its rows have the error and no vector.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order_col)
        try:
            vectors, kind, message = embedder.embed(part[text_col].fillna("").tolist()), None, None
        except Exception as e:  # noqa: BLE001  any failure of an encoder is its batch's
            vectors, kind, message = [None] * len(part), type(e).__name__, str(e)
        return part.assign(embedding=vectors, error_type=kind, error_message=message)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema) + ", embedding array<float>, error_type string, error_message string"
    return batches.groupBy("batch_id").applyInPandas(run, schema)


def embed_batches(records: DataFrame, embedder: Embedder, *, size: int = BATCH, order_col: str = "line_number", raw_col: str = "raw", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, units)``: embedded rows, and per batch ``batch_id, batch_hash, rows_in, error_type, error_message``. Each batch is encoded once.

    A batch whose encoder fails has an error and yields none of its rows.
    """
    numbered = staged(batched(records, order_col=order_col, size=size), "batches")
    done = staged(encode(numbered, embedder, order_col=order_col, text_col=text_col), "encoded")
    failed = done.groupBy("batch_id").agg(F.max("error_type").alias("error_type"), F.max("error_message").alias("error_message"))
    return done.filter("error_type is null").drop("error_type", "error_message"), batch_hashes(numbered, raw_col=raw_col).join(failed, "batch_id")
