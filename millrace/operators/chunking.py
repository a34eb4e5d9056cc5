"""Chunkers: Column builders that give an array of (seq, text), exploded by ``chunk``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import SPACE, trim

SIZE, OVERLAP, MAX_CHARS = 500, 100, 500
#: Finished chunks that are appended one by one; so many together are then appended as a block.
BLOCK = 256
_SENTENCE = f"(?<=[.!?]){SPACE}"


def fixed_size(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Windows at 0, size - overlap, ... while they begin inside the text; trimmed, empty ones skipped.

    A text a little longer than a step has a last window that lies inside the one before it.
    """
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    pieces = F.transform(starts, lambda i: trim(F.substring(text, i + 1, F.lit(size))))
    return F.filter(pieces, lambda p: p != "")


def sentences(text: Column, max_chars: int = MAX_CHARS) -> Column:
    """Sentences packed in order while they fit; one longer than ``max_chars`` is a chunk of its own, never cut.

    A fold in the JVM: finished blocks of chunks, the chunks after them and the open one. An append
    copies references to one block at most or to the blocks before it, so that a text of n chunks
    takes n * BLOCK / 2 + (n / BLOCK)^2 / 2 copies and not n^2 / 2. An empty text has none.
    """
    none = F.array().cast("array<string>")

    def step(acc: Column, sentence: Column) -> Column:
        full = (acc["open"] != "") & (F.length(acc["open"]) + F.length(sentence) + 1 > max_chars)
        whole = full & (F.size(acc["done"]) >= BLOCK)
        blocks = F.when(whole, F.concat(acc["blocks"], F.array(acc["done"]))).otherwise(acc["blocks"])
        ended = F.array(trim(acc["open"]))
        done = F.when(whole, ended).when(full, F.concat(acc["done"], ended)).otherwise(acc["done"])
        return F.struct(blocks.alias("blocks"), done.alias("done"), F.when(full, sentence).otherwise(trim(F.concat(acc["open"], F.lit(" "), sentence))).alias("open"))

    def end(acc: Column) -> Column:
        last = F.when(acc["open"] == "", none).otherwise(F.array(trim(acc["open"])))
        return F.concat(F.flatten(acc["blocks"]), acc["done"], last)

    start = F.struct(F.array().cast("array<array<string>>").alias("blocks"), none.alias("done"), F.lit("").alias("open"))
    return F.aggregate(F.split(text, _SENTENCE), start, step, end)


CHUNKERS: dict[str, Callable[..., Column]] = {"fixed": fixed_size, "sentence": sentences}


def chunk(df: DataFrame, strategy: str, *, id_col: str = "id", text_col: str = "text", **options: int) -> DataFrame:
    """A row per chunk: ``chunk_id, parent_id, seq, text`` beside the row's other columns."""
    pieces = CHUNKERS[strategy](F.col(text_col), **options)
    others = [c for c in df.columns if c not in (id_col, text_col, "chunk_id", "parent_id", "seq")]
    out = df.select(F.col(id_col).cast("string").alias("parent_id"), *others, F.posexplode(pieces).alias("seq", "text"))
    return out.select(F.concat_ws("-", "parent_id", "seq").alias("chunk_id"), "parent_id", F.col("seq").cast("long").alias("seq"), "text", *others)
