"""The vector store over Parquet snapshots: insert-if-absent, upsert, count and filtered top-k."""

from __future__ import annotations

import json
import uuid
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import vector as V
from millrace.operators.jobs import Jobs
from millrace.sources import sinks
from millrace.staging import scratch, staged


class VectorStore(Protocol):
    def upsert(self, rows: DataFrame) -> int: ...
    def query(self, vector: list[float], k: int = 5, min_rating: float | None = None) -> DataFrame: ...
    def count(self) -> int: ...


class ParquetStore:
    """The store is the segments that its newest version file lists, with their rows and the range of their ids.

    A load writes a segment of its own and then the next version, a small file that is there
    whole or not at all, so one that fails leaves the store as it was and a reader always has
    a whole one. Of two writers that began at the same version the second to publish is refused
    (FileExistsError) and can load again. Inserts never touch what is there; an upsert rewrites
    only the segments that hold ids it replaces. Segments whose ranges hold none of the ids that
    come in are left unread, and the others are searched in one job, however many there are.
    ``compact`` makes segments of all rows that follow each other by id.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, *, create: bool = False):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        if create and not self._versions():
            self._publish(0, [])

    def _versions(self) -> list[str]:
        return [n for n in sinks.names(self.spark, f"{self.path}/versions") if n.isdigit()]

    def _segments(self) -> tuple[int, list[dict]]:
        """The number of the newest version, and its segments: ``name, rows, low, high``."""
        versions = self._versions()
        if not versions:
            raise sinks.MissingStore(self.path)
        return int(versions[-1]), json.loads(sinks.read_text(self.spark, f"{self.path}/versions/{versions[-1]}"))

    def _publish(self, number: int, segments: list[dict]) -> None:
        sinks.publish_text(self.spark, f"{self.path}/versions/{number:012d}", json.dumps(segments))

    @staticmethod
    def _range(df: DataFrame) -> dict:
        """``rows, low, high, nulls`` of a table's ids, as strings in the order of their bytes."""
        name = F.col("id").cast("string")
        return df.agg(F.count("*").alias("rows"), F.min(name).alias("low"), F.max(name).alias("high"), F.count_if(name.isNull()).alias("nulls")).first().asDict()

    def _write(self, df: DataFrame) -> dict:
        """A new segment, not yet part of the store."""
        name = f"segment-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return {"name": name, **self._range(self._read([{"name": name}]))}

    def _read(self, segments: list[dict]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{s['name']}" for s in segments])

    @staticmethod
    def _near(segments: list[dict], ids: dict) -> list[dict]:
        """The segments that may hold an id of a range."""
        low, high = ids["low"], ids["high"]
        order = lambda x: x.encode()
        return [s for s in segments if (low is not None and s["low"] is not None and order(s["low"]) <= order(high) and order(low) <= order(s["high"])) or (ids["nulls"] and s["nulls"])]

    def read(self) -> DataFrame:
        return self._read(self._segments()[1])

    def count(self) -> int:
        return sum(s["rows"] for s in self._segments()[1])

    def insert(self, rows: DataFrame, *, order_col: str) -> int:
        """First write wins, metadata included; returns how many rows came in."""
        number, segments = self._segments()
        now = self._read(self._near(segments, self._range(rows)) if segments else [])
        new = self._write(sinks.insert_absent(rows, now, order_col=order_col).select(*now.columns))
        if new["rows"]:
            self._publish(number + 1, [*segments, new])
        return new["rows"]

    def upsert(self, rows: DataFrame, *, replaced: tuple[str, ...] = ("embedding", "document"), order_col: str | None = None) -> int:
        """Returns the whole store's count. Of rows with one id one counts, see ``sinks.upsert``."""
        number, segments = self._segments()
        near, held = self._near(segments, self._range(rows)) if segments else [], []
        if near:  # one job over the ids of all of them
            at = self._read(near).select("id", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("segment"))
            ids = rows.select(F.col("id").alias("__id")).distinct()
            hit = {r.segment for r in at.join(ids, F.col("id").eqNullSafe(F.col("__id")), "left_semi").select("segment").distinct().collect()}
            held = [s for s in near if s["name"] in hit]
        new = self._write(sinks.upsert(rows, self._read(held), replaced=replaced, order_col=order_col))
        left = [s for s in segments if s not in held]
        self._publish(number + 1, [*left, new])
        return sum(s["rows"] for s in left) + new["rows"]

    def compact(self, parts: int = 1) -> None:
        """One segment of all, or ``parts`` of them with ids in ranges, so that loads of a range of ids leave the others unread."""
        number, segments = self._segments()
        if parts == 1:
            return self._publish(number + 1, [self._write(self._read(segments))])
        with scratch():
            rows = staged(self._read(segments).repartitionByRange(parts, F.col("id").cast("string")).withColumn("__part", F.spark_partition_id()), "compact")
            found = sorted(r[0] for r in rows.select("__part").distinct().collect())
            made = [self._write(rows.filter(F.col("__part") == p).drop("__part")) for p in found]
        self._publish(number + 1, made)

    def query(self, vector: list[float], k: int = 5, min_rating: float | None = None) -> DataFrame:
        return search(self.read(), vector, k=k, metric="inner", min_rating=min_rating)


def search(chunks: DataFrame, vector: list[float], *, k: int = 5, metric: str = "cosine", min_rating: float | None = None, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """The best k of one query, ties by id: ``distance`` rising for cosine, ``score`` falling for inner product.

    ``min_rating`` of 0 or None filters nothing; else a null rating is left out. Scores use
    JVM expressions; the top k is kept per partition first. Scores equal to V.PLACES places tie.
    """
    rows = chunks.filter(F.col("rating") >= min_rating) if min_rating else chunks
    v = V.literal_vector(vector)
    if metric == "cosine":
        return rows.withColumn("distance", V.cosine_distance(F.col(vector_col), v)).orderBy(F.round("distance", V.PLACES), id_col).limit(k)
    return rows.withColumn("score", V.dot(F.col(vector_col), v)).orderBy(F.round("score", V.PLACES).desc(), id_col).limit(k)


def run_load(jobs: Jobs, store: ParquetStore, chunks: DataFrame, *, table: str = "chunks") -> int:
    """Upsert embedded chunks, as the job ``vecload:<table>``; its records out, and the result, are all rows of the store."""
    with jobs.job(f"vecload:{table}") as job:
        rows = chunks.select(F.col("chunk_id").alias("id"), F.col("text").alias("document"), "embedding", *[c for c in ("rating", "asin", "parent_asin", "helpful_vote") if c in chunks.columns])
        job["records_in"], job["records_out"] = rows.count(), store.upsert(rows)
    return job["records_out"]
