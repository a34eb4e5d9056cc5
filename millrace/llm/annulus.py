"""Centroid clustering in whole numbers by annulus search.

Centroids are sorted by norm. A vector's distance to the two centroids next to its own norm is
an upper bound u of its least distance, and no centroid whose norm lies further than u from the
vector's can be nearer; those within, boundaries included, are found by binary search and
compared exactly, the smaller number winning ties. u shrinks as nearer ones are found.

Components are whole numbers, so sums and distances have no rounding: doubles hold them while
every component is below 2**22, and Python's integers do in batches that go beyond.

Vectors are read once from the table and once a round from the shared folder; tasks give sums
and counts per centroid, no vector is ever shuffled. Driver and tasks hold the centroids, a
number that the caller sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernel as K
from millrace.llm.common import drop_staged, staged

#: Components below which distances of up to 128 dimensions are exact in doubles; bits of a limb in which sums travel; rows that are compared at once.
EXACT, LIMB, BLOCK = 1 << 22, 40, 4096
#: The largest magnitude of a float; what is not below it is not finite.
BEYOND = 2.0**128
LONG = (1 << 63) - 1


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles where those hold all distances exactly, else as Python's integers."""
    x = np.floor(x.astype(np.float64) * scale)
    return x if not x.size or np.abs(x).max() < EXACT else np.vectorize(int, otypes=[object])(x)


def _norms(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and its squared distance, for each row of whole numbers."""
    exact = x.dtype == np.float64 and x.shape[1] <= 128 and max((abs(e) for c in centroids for e in c), default=0) < EXACT
    kind = np.float64 if exact else object
    c = np.array(centroids, object).astype(kind)
    x = x if exact else (x if x.dtype == object else np.vectorize(int, otypes=[object])(x))
    cc = (c * c).sum(axis=1)
    order = np.argsort(_norms(cc), kind="stable")
    norms = _norms(cc)[order]
    number, least = np.zeros(len(x), np.int64), np.zeros(len(x), kind)
    for at in range(0, len(x), BLOCK):
        v = x[at : at + BLOCK]
        vv = (v * v).sum(axis=1)
        size = _norms(vv)
        beside = np.searchsorted(norms, size)
        best, who = None, None
        for side in (np.maximum(beside - 1, 0), np.minimum(beside, len(norms) - 1)):
            d, j = ((v - c[order[side]]) ** 2).sum(axis=1), order[side]
            nearer = np.ones(len(v), bool) if best is None else (d < best) | ((d == best) & (j < who))
            best, who = (d, j) if best is None else (np.where(nearer, d, best), np.where(nearer, j, who))
        slack = 1e-6 + 1e-9 * size
        bound = _norms(best) * (1 + 1e-9) + slack
        low, high = np.searchsorted(norms, size - bound, "left"), np.searchsorted(norms, size + bound, "right")
        for k in range(low.min(), high.max()):
            rows = np.flatnonzero((low <= k) & (k < high) & (np.abs(size - norms[k]) <= bound))
            if not len(rows):
                continue
            j = order[k]
            d = vv[rows] - 2 * (v[rows] @ c[j]) + cc[j]
            nearer = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
            won = rows[nearer]
            best[won], who[won] = d[nearer], j
            bound[won] = _norms(best[won]) * (1 + 1e-9) + slack[won]
        number[at : at + BLOCK], least[at : at + BLOCK] = who, best
    return number, least


def _matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims), scale)


_SUMS = "cluster int, place int, limb int, value long"


def _sums(centroids: list[list[int]], dims: int, scale: int):
    """Of each task: per cluster the sum of every component and, at place -1, the number of vectors, in signed limbs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dims, scale)
            number, _ = nearest(x, centroids)
            order = np.argsort(number, kind="stable")
            found, begins, counts = np.unique(number[order], return_index=True, return_counts=True)
            sums = np.add.reduceat(x[order], begins, axis=0)
            for j, total, n in zip(found.tolist(), sums, counts.tolist(), strict=True):
                held[j] = held.get(j, 0) + np.array([*map(int, total), n], object)
        rows = []
        for j, totals in held.items():
            for place, v in enumerate(totals):
                sign, v, limb = (1 if v >= 0 else -1), abs(v), 0
                while v:
                    rows.append((j, -1 if place == dims else place, limb, sign * (v & ((1 << LIMB) - 1))))
                    v, limb = v >> LIMB, limb + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "place", "limb", "value"])

    return run


def _moved(vectors: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """Every non-empty centroid at its vectors' floored mean."""
    sums = vectors.select("v").mapInArrow(K.released(_sums(centroids, dims, scale)), _SUMS).groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value"))
    totals: dict[tuple[int, int], int] = {}
    for r in sums.collect():  # centroids times components, and limbs of large sums
        totals[r.cluster, r.place] = totals.get((r.cluster, r.place), 0) + (r.value << LIMB * r.limb)
    return [[totals.get((j, p), 0) // totals[j, -1] for p in range(dims)] if (j, -1) in totals else c for j, c in enumerate(centroids)]


def _assign(centroids: list[list[int]], dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number, d = nearest(_matrix(batch.column(1), dims, scale), centroids)
            far = d > LONG
            d = pa.array([None if f else int(e) for e, f in zip(d.tolist(), far.tolist(), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), d], ["id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, k: int, *, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each kept vector.

    Kept are vectors of ``dims`` components, none null or non-finite (nor beyond a float's
    range); the others have no row. The first centroids are the ``k`` kept vectors of the
    smallest SHA-256 of ``seed:id`` (a null id as nothing; equal ids by their components), all
    where there are fewer. A round assigns each vector to the nearest centroid, the smaller
    number of equals, and moves those that have vectors to the floored mean; equal centroids
    are thus centroids of which the later stays empty. Rounds that would change nothing are
    left out. Repeated rows count each; distances and sums beyond a long are null. Extra
    columns are ignored; without kept vectors there are no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < BEYOND, F.lit(False)))
    rows = staged(rows.filter((F.size("v") == dims) & sound), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    centroids = [list(map(int, whole(np.array(r.v, np.float64), scale))) for r in rows.withColumn("key", key).orderBy("key", "v").limit(k).collect()]
    for _ in range(rounds if centroids else 0):
        moved = _moved(rows, centroids, dims, scale)
        if moved == centroids:
            break
        centroids = moved
    kind = rows.schema["id"].dataType.simpleString()
    found = staged(rows.mapInArrow(K.released(_assign(centroids, dims, scale)), f"id {kind}, cluster int, distance long"), "clusters")
    drop_staged(rows)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("far")).collect()
    fit = lambda v, far: None if far or v > LONG else int(v)
    inertia = fit(sum(r.total or 0 for r in sums), sum(r.far for r in sums))
    told = [(r.cluster, fit(r.total or 0, r.far), inertia, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in sums]
    # a row per centroid
    return found.join(F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
