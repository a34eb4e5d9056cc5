"""A chunk index: vectors in cells around centroids, of which a query searches the nearest few.

The exact search beside it is ``retrieval.batch_top_k``. Centroids are fitted on a bounded
sample, and so is how many cells a search probes; every vector is indexed. Cells are folders, so a
search reads only those it probes, and are dealt into parts of about PART vectors, each of which
meets its queries in a task of its own, by one product. Vectors are added to the cells there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import vector as V
from millrace.staging import scratch, staged

#: Vectors the centroids are fitted on, rounds of fitting, the most cells.
SAMPLE, ROUNDS, MOST_CELLS = 32_768, 8, 4096
#: Vectors, and queries, of a part of a cell.
PART, ASKED = 16_384, 4096
#: How many of the sample are searched for to fit the probes, for so many neighbours, and the share to find.
TRIED, NEIGHBOURS, FOUND = 512, 10, 0.97


def fit(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Unit centroids by spherical k-means; a centroid that loses all its vectors stays where it was."""
    x = sample / np.sqrt((sample * sample).sum(axis=1, keepdims=True))
    centroids = x[np.random.default_rng(seed).permutation(len(x))[:cells]].copy()
    for _ in range(ROUNDS):
        own = (x @ centroids.T).argmax(axis=1)
        for c in np.unique(own):
            total = x[own == c].sum(axis=0)
            if n := math.sqrt(float(total @ total)):
                centroids[c] = total / n
    return centroids


def fitted_probes(sample: np.ndarray, centroids: np.ndarray) -> int:
    """How many of its nearest cells a vector must search to find FOUND of its nearest neighbours within the sample."""
    x = sample / np.sqrt((sample * sample).sum(axis=1, keepdims=True))
    home = (x @ centroids.T).argmax(axis=1)
    q = x[:TRIED]
    score = q @ x.T
    score[np.arange(len(q)), np.arange(len(q))] = -2
    near = np.argsort(-score, axis=1)[:, :NEIGHBOURS]
    cells = q @ centroids.T
    rank = (cells[:, None, :] > np.take_along_axis(cells, home[near], axis=1)[:, :, None]).sum(axis=2) + 1
    return int(np.quantile(rank, FOUND, method="higher"))


def _nearest(centroids: np.ndarray, probes: int):
    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            score = np.stack(s.to_numpy()).astype(np.float64) @ centroids.T
            yield pd.Series(np.argsort(-score, axis=1, kind="stable")[:, :probes].astype(np.int32).tolist())

    return run


def _rows(vectors: DataFrame, id_col: str, vector_col: str, keep: tuple[str, ...]) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    return vectors.select(F.col(id_col).alias("id"), v.alias("v"), *keep).filter(F.col("v").isNotNull() & (V.norm(F.col("v")) > 0))


def _dealt(rows: DataFrame, size: int, key: str) -> DataFrame:
    """``part`` of each row within its ``cell``, as many parts as its rows ask for; a row per cell is broadcast."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("__parts"))
    return rows.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64(key), "__parts").cast("int")).drop("__parts")


def _put(rows: DataFrame, centroids: np.ndarray, path: str, mode: str) -> None:
    """Write vectors into their cells, a task for each part of one."""
    with scratch():
        placed = staged(rows.withColumn("cell", F.element_at(_nearest(centroids, 1)("v"), 1)), "placed")
        _dealt(placed, PART, "id").repartition("cell", "part").drop("part").write.mode(mode).partitionBy("cell").parquet(f"{path}/cells")


def build(corpus: DataFrame, path: str, *, id_col: str = "id", vector_col: str = "embedding", cells: int | None = None, keep: tuple[str, ...] = ()) -> None:
    """Write the index of every vector that isn't null or zero: ``cells`` (id, v, cell) and ``centroids``.

    ``cells`` follows the root of the number of vectors if it isn't given. Columns named in
    ``keep`` are kept beside the vectors, for searches to filter by.
    """
    spark = corpus.sparkSession
    rows = _rows(corpus, id_col, vector_col, keep)
    n = rows.count()
    if not n:  # no centroids: one empty cell
        rows.withColumn("cell", F.lit(0)).write.mode("overwrite").parquet(f"{path}/cells")
        spark.createDataFrame([], "cell INT, v ARRAY<DOUBLE>, probes INT").write.mode("overwrite").parquet(f"{path}/centroids")
        return
    place = F.shiftrightunsigned(F.xxhash64("id"), 16)
    few = rows.filter(place < int(min(1.0, 1.2 * SAMPLE / n) * (1 << 48)))  # so that tasks send little more than the sample
    sample = np.array([r.v for r in few.orderBy(place).limit(SAMPLE).select("v").collect()])
    centroids = fit(sample, min(MOST_CELLS, cells or math.ceil(math.sqrt(n)), len(sample)))
    _put(rows, centroids, path, "overwrite")
    probes = fitted_probes(sample, centroids)
    spark.createDataFrame([(i, c.tolist(), probes) for i, c in enumerate(centroids)], "cell INT, v ARRAY<DOUBLE>, probes INT").write.mode("overwrite").parquet(f"{path}/centroids")


def _centroids(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    told = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    return np.array([r.v for r in told]), told[0].probes if told else 0


def add(vectors: DataFrame, path: str, *, id_col: str = "id", vector_col: str = "embedding", keep: tuple[str, ...] = ()) -> None:
    """Put more vectors into the cells of an index, with the columns that it keeps; what is there is not touched.

    The centroids stay, so an index that has grown far beyond what it was fitted on should be
    built anew. An index of nothing is built.
    """
    centroids, _ = _centroids(vectors.sparkSession, path)
    if len(centroids):
        _put(_rows(vectors, id_col, vector_col, keep), centroids, path, "append")
    else:
        build(vectors, path, id_col=id_col, vector_col=vector_col, keep=keep)


def search(spark: SparkSession, path: str, queries: DataFrame, *, k: int = 5, probes: int | None = None, where: str | None = None, query_id: str = "query_id", query_vector: str = "vector") -> DataFrame:
    """``query_id, id, score, rank`` by cosine distance over the ``probes`` cells nearest to each query (as many as the index was fitted to, if it isn't given).

    Distances are exact, ties go by id; what lies in other cells isn't found. With all cells
    probed the result is that of the exact search. ``where``: a condition on the columns that the
    index keeps, for vectors that count at all (``rating >= 4``); it is applied before the best k
    are taken. Null and zero queries find nothing.
    """
    centroids, fitted_to = _centroids(spark, path)
    held = spark.read.parquet(f"{path}/cells")
    held = (held.filter(where) if where else held).select("id", "v", "cell")
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & (V.norm(F.col("v")) > 0))
    if len(centroids):
        probes = min(len(centroids), probes or fitted_to)
        asked = asked.withColumn("cell", F.explode(_nearest(centroids, probes)("v")))
    else:
        asked = asked.withColumn("cell", F.lit(0))
    asked = _dealt(staged(asked, "asked"), ASKED, "query_id").withColumnRenamed("part", "q_part")
    held = _dealt(held, PART, "id")
    # each part of a cell's queries meets each part of its vectors
    spread = lambda rows, other, part: rows.join(F.broadcast(other.groupBy("cell").agg(F.max(part).alias("__most"))), "cell").withColumn(part, F.explode(F.sequence(F.lit(0), F.col("__most")))).drop("__most")
    left, right = spread(asked, held, "part"), spread(held, asked, "q_part")

    def meet(some: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(vectors):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        return V.best(some, vectors.sort_values("id"), k, "cosine")

    kinds = f"query_id {asked.schema['query_id'].dataType.simpleString()}, id {held.schema['id'].dataType.simpleString()}, score double"
    met = left.groupBy("cell", "q_part", "part").cogroup(right.groupBy("cell", "q_part", "part")).applyInPandas(meet, kinds)
    order = Window.partitionBy("query_id").orderBy(F.round("score", V.PLACES), "id")
    return met.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``n, recall``: the share of the exact hits (query_id, id) that were found."""
    hit = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hit.agg(F.count("*").alias("n"), F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0)).alias("recall"))
