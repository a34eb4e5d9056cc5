"""Cleaning, filtering, deduplication and fixed-size batching of reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions import text as X
from millrace.staging import staged

MIN_TEXT_STRIP_FIRST, MIN_TEXT_DECODE_FIRST, BATCH = 15, 20, 32


def clean_records(df: DataFrame, *, min_text_length: int = MIN_TEXT_STRIP_FIRST) -> DataFrame:
    """Rows with a rating and a cleaned text long enough; title and text cleaned, every other column as it was.

    Length counts the cleaned text and is strict from below; a rating of 0 stays; a title never filters.
    """
    cleaned = df.withColumns({c: X.clean_strip_first(F.coalesce(F.col(c), F.lit(""))) for c in ("title", "text") if c in df.columns})
    return cleaned.filter(F.col("rating").isNotNull() & (F.length("text") >= min_text_length))


def clean_records_decoded(df: DataFrame, *, min_text_length: int = MIN_TEXT_DECODE_FIRST) -> DataFrame:
    cleaned = df.withColumn("text", X.clean_decode_first(F.coalesce(F.col("text"), F.lit(""))))
    return cleaned.filter(F.col("rating").isNotNull() & (F.length("text") >= min_text_length))


_HASHABLE = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType)


def first_of(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key (null is a key), columns as they were: that of the smallest ``order_col``, null last.

    Of rows that tie, the one with the smaller hash of its plain columns; of rows alike in
    these, any. A grouped minimum of whole rows: it combines before the shuffle, so a key with
    very many rows is never gathered, and the input is evaluated once.
    """
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _HASHABLE)]
    order = F.struct(F.col(order_col).isNull(), order_col, F.xxhash64(*plain) if plain else F.lit(0))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("__row"))
    return best.select("__row.*")


def dedup_first(df: DataFrame, *, order_col: str, text_col: str = "text", ignore_case: bool = False, seen: DataFrame | None = None, hash_col: str | None = None) -> DataFrame:
    """The first row, by ``order_col``, of each text; rows whose hash is in ``seen(hash)`` are left out.

    Null texts are one text. One row stays of each text, whatever ties or nulls ``order_col``
    has (see :func:`first_of`). The hash stays as ``hash_col`` if that is given.
    """
    name = hash_col or "__hash"
    rows = df.withColumn(name, X.text_hash(F.col(text_col)) if ignore_case else X.content_hash(F.col(text_col)))
    if seen is not None:
        rows = rows.join(seen.select(F.col("hash").alias("__seen")), F.col(name).eqNullSafe(F.col("__seen")), "left_anti")
    first = first_of(rows, [name], order_col)
    return first if hash_col else first.drop(name)


def text_hashes(df: DataFrame, *, text_col: str = "text", ignore_case: bool = False) -> DataFrame:
    """``hash``: what later calls of :func:`dedup_first` take as ``seen``."""
    h = X.text_hash(F.col(text_col)) if ignore_case else X.content_hash(F.col(text_col))
    return df.select(h.alias("hash")).distinct()


def ranked(df: DataFrame, order_col: str | list[str], name: str = "rank") -> DataFrame:
    """Dense positions from 0 in the order of a column (or several), without a global sort in one task.

    Rows are range-partitioned and written to the shared folder with their part and place, since
    each evaluation of a range partitioning draws its own bounds; what is written is then numbered
    from the rows of the parts before. Rows that tie are numbered in any order.
    """
    order = [order_col] if isinstance(order_col, str) else order_col
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__place", place)
    ordered = staged(ordered, "ranked")
    return _numbered(ordered, "__place", name).drop("__place")


def _numbered(df: DataFrame, place_col: str, name: str) -> DataFrame:
    """Dense positions from 0 by a stored ``monotonically_increasing_id``: a part's rows follow those of all parts before it."""
    part = F.shiftright(place_col, 33)
    sizes = df.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    rows = df.withColumn("__part", part).join(F.broadcast(before), "__part")  # a row per part
    return rows.withColumn(name, F.col("__before") + F.col(place_col).bitwiseAND((1 << 33) - 1)).drop("__part", "__before")


def batched(df: DataFrame, *, order_col: str, size: int = BATCH) -> DataFrame:
    """Consecutive batches of ``size`` rows in ``batch_id``; the last may be short."""
    return ranked(df, order_col, "__rank").withColumn("batch_id", F.floor(F.col("__rank") / size)).drop("__rank")


def batch_hashes(df: DataFrame, *, raw_col: str = "raw", batch_col: str = "batch_id") -> DataFrame:
    """``batch_id, batch_hash, rows_in``: a batch's identity whatever the order of its rows."""
    hashes = F.array_join(F.sort_array(F.collect_list(X.content_hash(F.col(raw_col)))), "\n")
    return df.groupBy(batch_col).agg(F.sha2(hashes, 256).alias("batch_hash"), F.count("*").alias("rows_in"))
