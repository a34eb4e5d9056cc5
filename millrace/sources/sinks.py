"""Sinks: stage artifacts, and the two ways of loading a keyed store on plain Parquet."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cleaning import first_of


class MissingStore(FileNotFoundError):
    """A store is read that was never written; an empty one in its place would hide the mistake."""


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; of none, nothing."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another name, then renamed. What is there already stays, and is a FileExistsError."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    fs = new(path).getFileSystem(spark._jsc.hadoopConfiguration())
    draft = new(f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.isAbsolute() and draft.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(draft, new(path), plain)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise FileExistsError(path) from e
        raise


def read_text(spark: SparkSession, path: str) -> str:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def insert_absent(incoming: DataFrame, existing: DataFrame, *, id_col: str = "id", order_col: str) -> DataFrame:
    """The rows to append: ids that the store hasn't, the first by ``order_col`` of each; first write wins.

    A null id is an id; ties and null order values leave one row as well (see ``cleaning.first_of``).
    """
    held = existing.select(F.col(id_col).alias("__held"))
    new = incoming.join(held, F.col(id_col).eqNullSafe(F.col("__held")), "left_anti")
    return first_of(new, [id_col], order_col).select(*incoming.columns)


def upsert(incoming: DataFrame, existing: DataFrame, *, id_col: str = "id", replaced: tuple[str, ...] = ("embedding", "document"), order_col: str | None = None) -> DataFrame:
    """The store's next snapshot: ids present keep all but the ``replaced`` columns, new ids are added whole.

    Of incoming rows with one id that of the smallest ``order_col`` counts, without it or of equal
    ones that of the smallest hash (see ``cleaning.first_of``). A null id is an id.
    """
    new, old = first_of(incoming, [id_col], order_col or id_col).withColumn("__new", F.lit(True)).alias("n"), existing.withColumn("__old", F.lit(True)).alias("o")
    joined = new.join(old, F.col(f"n.{id_col}").eqNullSafe(F.col(f"o.{id_col}")), "full_outer")
    was, comes = F.col("o.__old").isNotNull(), F.col("n.__new").isNotNull()
    columns = [F.coalesce(f"n.{id_col}", f"o.{id_col}").alias(id_col)]
    for c in (c for c in existing.columns if c != id_col):
        columns.append((F.when(comes, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in replaced else F.when(was, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))).alias(c))
    return joined.select(*columns)
