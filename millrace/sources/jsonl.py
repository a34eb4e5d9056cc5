"""Line-delimited JSON with line numbers, strict or with bad lines set aside; metadata and gold sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace import schemas
from millrace.functions.text import trim
from millrace.sources import remote


class MalformedRecord(ValueError):
    """A line that isn't JSON: its number and its text. Resume with ``skip`` set to the number."""

    def __init__(self, line_number: int, raw: str):
        super().__init__(f"line {line_number} is not JSON: {raw[:200]}")
        self.line_number, self.raw = line_number, raw


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_number, raw``: every physical line from 1, blank ones too, surrounding white space off.

    Files follow each other by path, lines by place: each split's lines are counted first, and
    a line's number is its place in its split and the lines of all splits before. No line is
    moved, and both passes see the same splits as long as the files don't change. A path that
    begins with http:// or https:// is read from there (see ``sources.remote``).
    """
    if remote.is_remote(path):
        return remote.read_lines(spark, path)
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    splits = lines.groupBy("file_path", "file_block_start").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.orderBy("file_path", "file_block_start")) - F.col("n")
    splits = splits.select("file_path", "file_block_start", "first", before.alias("before"))  # a row per split
    numbered = lines.join(F.broadcast(splits), ["file_path", "file_block_start"])
    return numbered.select((F.col("before") + F.col("place") - F.col("first") + 1).alias("line_number"), trim(F.col("value")).alias("raw"))


def parse_lines(lines: DataFrame, *, schema: str = schemas.REVIEW) -> DataFrame:
    """``line_number, raw, data, variant, error_type, error_message``; blank lines are gone, their numbers kept.

    ``data`` has the known fields, ``variant`` the whole object with every unknown key. A line
    that isn't a JSON object is a ``MalformedRecord``; a text that isn't a string a ``TypeError``
    (Spark alone would turn it into one).
    """
    rows = lines.filter(F.col("raw") != "").withColumn("variant", F.try_parse_json("raw"))
    kind = F.schema_of_variant(F.try_variant_get("variant", "$.text", "variant"))
    malformed = F.col("variant").isNull()
    odd = kind.isNotNull() & ~kind.isin("STRING", "VOID")
    error_type = F.when(malformed, "MalformedRecord").when(odd, "TypeError")
    message = F.when(malformed, F.concat(F.lit("line "), F.col("line_number").cast("string"), F.lit(" is not JSON: "), F.substring("raw", 1, 200))).when(odd, F.concat(F.lit("text is "), kind))
    return rows.select("line_number", "raw", F.from_json("raw", schema).alias("data"), "variant", error_type.alias("error_type"), message.alias("error_message"))


def read_reviews(spark: SparkSession, path: str, *, skip: int = 0, limit: int | None = None, strict: bool = False) -> DataFrame:
    """Parsed lines after ``skip`` physical lines, ``limit`` records at most.

    ``strict`` gives the records before the first malformed line, or raises where that line is
    the first record left. Otherwise malformed lines stay as rows with ``error_type``.
    """
    lines = remote.first_lines(spark, path, skip=skip, limit=limit) if limit is not None and remote.is_remote(path) else read_lines(spark, path)
    rows = parse_lines(lines.filter(F.col("line_number") > skip))
    if strict:
        bad = rows.filter(F.col("error_type") == "MalformedRecord").orderBy("line_number").select("line_number", "raw").first()
        if bad:
            before = rows.filter(F.col("line_number") < bad.line_number)
            if before.isEmpty() and limit != 0:
                raise MalformedRecord(bad.line_number, bad.raw)
            rows = before
    return rows if limit is None else rows.orderBy("line_number").limit(limit)


def load_product_meta(meta: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``parent_asin, title, category``: of each wanted key (of every key, without ``wanted``) the first record by ``line_number``."""
    kept = meta if wanted is None else meta.join(wanted.select("parent_asin").distinct(), "parent_asin", "left_semi")
    first = kept.groupBy("parent_asin").agg(F.min_by(F.struct("title", "main_category"), "line_number").alias("m"))
    return first.select("parent_asin", "m.title", F.col("m.main_category").alias("category"))


def read_gold_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``query, chunk_id, chunk_text`` of a JSON file with a list under ``pairs``."""
    whole = spark.read.schema(f"pairs ARRAY<STRUCT<{schemas.GOLD_PAIR.replace(' STRING', ': STRING')}>>").option("multiLine", True).json(path)
    return whole.select(F.inline("pairs"))


def read_gold_questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLD_QUESTION).json(path)
