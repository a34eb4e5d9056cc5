"""Session and staging helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.staging import drop_staged, fresh_dir, shared_dir, staged, staging

__all__ = ["drop_staged", "fresh_dir", "row_key", "shared_dir", "staged", "staging", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a range of rows that one task works through in order, and the most ranges of a table.
RANGE_BYTES, MOST_RANGES = 16 << 20, 20_000


def ranges_for(size: int | None, least: int = RANGE_BYTES) -> int:
    """How many ranges a table of so many bytes is dealt into: by its size alone, so reruns on any cluster agree."""
    return min(MOST_RANGES, max(1, -(-(size or 0) // least)))


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit key of a row by id and text; used beside the id itself, so that repeated ids stay apart."""
    return F.xxhash64(F.col(id_col), F.col(text_col))
