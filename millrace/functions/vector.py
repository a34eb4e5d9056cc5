"""Vector functions: Column forms for a single query, one NumPy product per Arrow batch for many."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal places to which scores are compared; beyond them ties go by id.
PLACES = 12
#: Queries and corpus vectors of a block; a pair of blocks is a task's unit.
QUERY_BLOCK, CORPUS_BLOCK = 16_384, 16_384
#: Scores that a task holds at once, 4 MB of them.
SCORES = 1 << 19


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / (norm(a) * norm(b))


def negative_inner_product(a: Column, b: Column) -> Column:
    return -dot(a, b)


def l2_normalize(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def literal_vector(values: list[float]) -> Column:
    return F.lit(np.asarray(values, float).tolist()).cast("array<double>")


def _matrix(vectors: pd.Series, unit: bool) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype(np.float64, copy=False)
    if unit:
        m /= np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return m


def best(queries: pd.DataFrame, corpus: pd.DataFrame, k: int, metric: str) -> pd.DataFrame:
    """``query_id, id, score`` of the best k of a block of the corpus for each query of a block, ties by id.

    As many queries at once as make SCORES scores: beside the two blocks a task holds a few arrays of that size.
    """
    matrix, x = (_matrix(t["v"], metric == "cosine") for t in (queries, corpus))
    ids, qids, parts = corpus["id"].to_numpy(), queries["query_id"].to_numpy(), []
    at_once = max(1, SCORES // max(1, len(x)))
    for at in range(0, len(matrix), at_once):
        score = matrix[at : at + at_once] @ x.T
        value = 1 - score if metric == "cosine" else score
        best = np.argsort(np.round(value if metric == "cosine" else -value, PLACES), axis=1, kind="stable")[:, :k]
        parts.append(pd.DataFrame({"query_id": np.repeat(qids[at : at + at_once], best.shape[1]), "id": ids[best.ravel()], "score": np.take_along_axis(value, best, axis=1).ravel()}))
    return pd.concat(parts)


def top_k_candidates(corpus: DataFrame, queries: DataFrame, k: int, *, id_col: str, vector_col: str, metric: str, query_id: str, query_vector: str) -> DataFrame:
    """``query_id, id, score`` of each block of the corpus's best k per query, ties by id.

    Queries and corpus are dealt into blocks by hash, as many as their counts ask for; each
    query block meets each corpus block in one task, by one product. A unit holds two blocks,
    whatever the sizes of the tables, and k rows per query and corpus block go on. Nothing
    comes to the driver but the counts. ``score``: cosine distance (ascending) or inner product (descending).
    """
    q = queries.filter(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v"))
    c = corpus.filter(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    nq, nc = (max(1, -(-t.count() // size)) for t, size in ((q, QUERY_BLOCK), (c, CORPUS_BLOCK)))
    kinds = q.schema["query_id"].dataType, c.schema["id"].dataType
    # the block of a query follows each block of the corpus, and the other way round
    q = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(nq))).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)).cast("array<long>")))
    c = c.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(nc))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<long>")))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        return best(left, right.sort_values("id"), k, metric)  # a stable sort by score then breaks ties by id

    schema = T.StructType([T.StructField("query_id", kinds[0]), T.StructField("id", kinds[1]), T.StructField("score", T.DoubleType())])
    return q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(meet, schema)
