"""Embedding near-dedup: a pivot-permutation index, with its exact form as an option.

Pivots are reference points spread over a bounded sample of the vectors: each is the one farthest
from those before it, so a group of near copies holds one pivot however many vectors it has. A
vector is described by its nearest pivots in order, the first of which is its home. The inverted
list of a pivot holds the vectors that have it as their home, and is visited by the vectors that
have it among their NEAREST; of two pivots one sends visitors to the other, so a pair meets once.
Retrieved pairs that share fewer than SHARED of their nearest pivots are refused, the others are
verified: by a product of single precision, and by cosine in double precision where that is
within its error of the threshold.

How many pivots count as nearest is fitted on the sample: at least NEAREST, and as many as it takes
to find FOUND of the links between its first vectors, and of links made from these at the threshold. A visit is left out where it can't bring a
link: vectors farther from the hyperplane midway between two pivots than linked vectors can be
apart have none on its other side. With ``nearest=0`` that bound alone decides and no pair is lost.

Equal vectors of a label are one class from the start. Lists of a label are dealt into blocks of
at most about BLOCK, and a pair of blocks is a task's unit, so memory is bounded. A unit returns,
per vector, how many vectors it links there and one link per component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernel as K
from millrace.llm.common import staged
from millrace.llm.components import components

#: Most pivots of a dimension, pivots to the root of the most frequent label's vectors, vectors they are chosen from; vectors in a block.
PIVOTS, PER_ROOT, SAMPLE, BLOCK = 8192, 4, 32_768, 2048
#: Pivots that describe a vector, at least; those that a pair shares; the share of the sample's links to find, and of links made at the threshold; vectors of the sample whose links are looked for.
NEAREST, SHARED, FOUND, MADE, TRIED = 24, 2, 0.998, 0.995, 4096
#: Scores of vectors with pivots that a task holds at once.
SCORES = 1 << 21


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Packed vectors of one length -> a matrix of unit rows, in doubles."""
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32, len(column) + 1, column.offset * 4)
    x = np.frombuffer(data, kind, (offs[-1] - offs[0]) // np.dtype(kind).itemsize, offs[0]).reshape(len(column), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _packed(kind: str):
    """Lists -> their components, packed; null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.ascontiguousarray(pc.fill_null(column.flatten(), math.nan).to_numpy(zero_copy_only=False), kind)
            at = np.concatenate([[0], np.cumsum(n)])
            within = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
            ok = (n > 0) & (within(~np.isfinite(x)) == 0) & (within(x != 0) > 0)
            bits = pa.py_buffer(np.packbits(ok, bitorder="little").tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(n), [bits, pa.py_buffer((at * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), packed], ["id", "label", "x"])

    return run


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Of unit rows, ``count`` at most, each the farthest from those before it; rows within rounding of one are passed over."""
    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        at = int(near.argmin())
        if near[at] > 1 - 1e-9:
            break
        chosen.append(at)
        near = np.maximum(near, sample @ sample[at])
    return sample[chosen]


def _sends(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether vectors of one home visit the list of another: of two pivots one does."""
    return (other != own) & (((other + own) % 2 == 0) == (other > own))


def _partners(x: np.ndarray, least: float) -> np.ndarray:
    """For each unit row one that links with it as barely as may be: half of them away in a direction in which rows spread, half in any."""
    rng = np.random.default_rng(11)
    other = rng.normal(size=x.shape)
    # sums of many rows, not single ones, which may be pivots themselves
    other[::2] = rng.normal(size=(len(other[::2]), min(256, len(x)))) @ x[:256]
    away = other - (other * x).sum(axis=1, keepdims=True) * x
    length = np.sqrt((away * away).sum(axis=1, keepdims=True))
    return least * x + math.sqrt(max(0.0, 1 - least * least)) * away / np.where(length == 0, 1, length)


def fitted(sample: np.ndarray, pivots: np.ndarray, least: float) -> int:
    """How many nearest pivots find FOUND of the links among the first TRIED of the sample, and MADE of those between these and partners made at the threshold.

    Links within a sample get rarer as the table grows; partners are there at any size.
    """
    x = sample[:TRIED]
    score = x @ pivots.T
    own = score.argmax(axis=1)
    needed = []
    for k in range(0, len(x), 512):
        i, j = np.nonzero(x[k : k + 512] @ x.T >= least)
        i = i + k
        at = np.flatnonzero(_sends(own[i], own[j]))[: 1 << 14]
        i, j = i[at], j[at]
        needed.append((score[i] >= score[i, own[j]][:, None]).sum(axis=1) if len(i) else np.zeros(0, np.int64))
    home = (_partners(x, least) @ pivots.T).argmax(axis=1)
    made = (score >= np.take_along_axis(score, home[:, None], axis=1)).sum(axis=1)[home != own]
    most = NEAREST
    for found, share in ((np.concatenate(needed), FOUND), (made, MADE)):
        if len(found):
            most = max(most, int(np.sort(found)[min(len(found) - 1, math.ceil(share * len(found)))]))
    return most


def rounded(pivots: np.ndarray) -> np.ndarray:
    """As they are sent: in single precision."""
    return pivots.astype(np.float32)


def _unit(pivots: np.ndarray) -> np.ndarray:
    """As they are used, on driver and workers alike."""
    p = pivots.astype(np.float64)
    return p / np.sqrt((p * p).sum(axis=1, keepdims=True))


def _cells(pivots: dict[int, np.ndarray], nearest: dict[int, int], least: float, kind: str):
    """Adds ``cells``: the vector's home, then the lists that it visits; and ``near``: its nearest pivots, packed."""
    apart = math.sqrt(max(0.0, 2 - 2 * least))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """As many rows at once as a table of SCORES with the pivots holds."""
        rows = max(64, SCORES // max((len(p) for p in pivots.values()), default=1))
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                yield pa.Table.from_batches([batch.slice(k, rows)]).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {d: _unit(p) for d, p in pivots.items()}
        for batch in blocks(batches):
            dims = pc.binary_length(batch.column("x")).to_numpy() // np.dtype(kind).itemsize
            rows, cells = [np.arange(batch.num_rows)], [np.zeros(batch.num_rows, np.int32)]
            near: list = [b""] * batch.num_rows
            for d in np.unique(dims).tolist():
                if d not in pivots:
                    continue  # no pivot of this dimension was drawn: all have the first list as their home
                at = np.flatnonzero(dims == d)
                score = _matrix(batch.column("x").take(pa.array(at)), kind) @ units[d].T
                own = score.argmax(axis=1)
                cells[0][at] = own
                # (own score - score) / distance of the pivots is the distance from the hyperplane
                homes, which = np.unique(own, return_inverse=True)
                between = np.sqrt(np.maximum(0, 2 - 2 * units[d][homes] @ units[d].T))
                visits = score.max(axis=1, keepdims=True) - score <= apart * between[which] + 1e-6
                visits &= _sends(own[:, None], np.arange(score.shape[1])[None, :])
                k = nearest[d]
                if 0 < k < score.shape[1]:
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    close = np.zeros(score.shape, bool)
                    np.put_along_axis(close, top, True, axis=1)
                    visits &= close
                    top = np.sort(top, axis=1).astype("<u2")
                    for i, row in zip(at.tolist(), top, strict=True):
                        near[i] = row.tobytes()
                i, other = np.nonzero(visits)
                rows.append(at[i])
                cells.append(other.astype(np.int32))
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")  # homes come first
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(cells)[order]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(near, pa.binary())], [*batch.schema.names, "cells", "near"])

    return run


def _shared(near: pa.ChunkedArray, a: np.ndarray, b: np.ndarray, found: np.ndarray) -> None:
    """Takes back from ``found`` the pairs that share fewer than SHARED of their nearest pivots."""
    if not found.any():
        return
    raw = near.to_pylist()
    if not raw[0]:
        return
    near = np.frombuffer(b"".join(raw), "<u2").reshape(len(raw), -1)
    i, j = np.nonzero(found)
    for k in range(0, len(i), 1 << 16):
        x, y = near[a[i[k : k + (1 << 16)]]], near[b[j[k : k + (1 << 16)]]]
        both = np.sort(np.concatenate([x, y], axis=1), axis=1)
        few = (both[:, 1:] == both[:, :-1]).sum(axis=1) < SHARED
        found[i[k : k + (1 << 16)][few], j[k : k + (1 << 16)][few]] = False


def _linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two matrices of unit rows have a cosine of ``least`` or more."""
    score = x.astype(np.float32) @ y.astype(np.float32).T
    error = (x.shape[1] + 4) * 2.0**-22
    found = score >= np.float32(least)
    i, j = np.nonzero(np.abs(score - np.float32(least)) <= np.float32(error))
    for k in range(0, len(i), 1 << 16):
        a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
        found[a, b] = (x[a] * y[b]).sum(axis=1) >= least
    return found


def _roots(found: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per row and per column, the component in the bipartite graph (in the graph, if ``same``), or -1 without a link."""
    n, m = found.shape
    row, col = np.full(n, -1), np.full(m, -1)
    for first in np.flatnonzero(found.any(axis=1)).tolist():
        if row[first] >= 0:
            continue
        rows = np.array([first])
        row[first] = first
        while len(rows):
            new = found[rows].any(axis=0) & (col < 0)
            col[new] = first
            rows = np.flatnonzero(new) if same else np.flatnonzero(found[:, new].any(axis=1))
            rows = rows[row[rows] < 0]
            row[rows] = first
    return row, col


def _link(least: float, kind: str):
    def unit(node: np.ndarray, count: np.ndarray, x: np.ndarray, near: pa.ChunkedArray, side: np.ndarray, same: bool) -> pa.RecordBatch | None:
        """Links of one pair of blocks, or within one: ``side`` says which rows are the first block's."""
        a = np.arange(len(node)) if same else np.flatnonzero(side)
        b = a if same else np.flatnonzero(~side)
        found = _linked(x[a], x[b], least)
        _shared(near, a, b, found)
        if same:
            found = np.triu(found, 1)
            found |= found.T
        if not found.any():
            return None
        degree, root = np.zeros(len(node), np.int64), np.full(len(node), -1)
        row, col = _roots(found, same)
        for k in range(0, len(a), 256):
            degree[a[k : k + 256]] = found[k : k + 256] @ count[b]
        root[a] = row
        if not same:
            for k in range(0, len(b), 256):
                degree[b[k : k + 256]] = count[a] @ found[:, k : k + 256]
            root[b] = col
        at = np.flatnonzero(degree)
        return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(degree[at]), pa.array(node[a[root[at]]])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            unit_no = table.column("unit").to_numpy()
            firsts = np.concatenate([[0], np.flatnonzero(unit_no[1:] != unit_no[:-1]) + 1])
            for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                if (out := settle(table.slice(a, b - a))) is not None:
                    yield out
            held = table.slice(int(firsts[-1])).combine_chunks().to_batches()[0]
        if held is not None and (out := settle(pa.Table.from_batches([held]))) is not None:
            yield out

    def settle(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        block, i, j = (t.column(c).to_numpy() for c in ("block", "i", "j"))
        same = bool(i[0] == j[0])
        side = block == i[0]
        if not same and (side.all() or not side.any()):
            return None
        return unit(t.column("node").to_numpy(), t.column("n").to_numpy(), _matrix(t.column("x").combine_chunks(), kind), t.column("near"), side, same)

    return run


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, nearest: int | None = None) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    Vectors of equal, non-null labels and equal dimensions link where their cosine is
    ``least`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is
    the smallest id reachable, ``kept`` says it is the row's own. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing. Repeated rows link
    with each other. Other columns are ignored; an empty table gives no rows.

    ``nearest``: pivots that describe a vector; None fits it on the sample, 0 is exact. No
    link is given that isn't one; of the links the index may miss a few in a thousand.
    """
    spark = vectors.sparkSession
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind, size = ("<f4", 4) if single else ("<f8", 8)  # components go as they are, which loses nothing
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    rows = base.mapInArrow(K.released(_packed(kind)), f"id {kinds[id_col]}, label {kinds[label_col]}, x binary")
    rows = staged(rows.withColumn("node", F.when(F.col("label").isNotNull() & F.col("x").isNotNull(), F.xxhash64("label", "x"))), "vectors")
    classes = rows.filter("node is not null").groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("min_id"), F.first("label").alias("label"), F.first("x").alias("x"))
    classes = staged(classes, "classes")
    sizes = classes.groupBy((F.octet_length("x") / size).cast("int").alias("d"), "label").agg(F.count("*").alias("c"))
    dims = sizes.groupBy("d").agg(F.sum("c").alias("c"), F.max("c").alias("most")).orderBy(F.desc("c")).limit(64).collect()
    pivots, counts = {}, {}
    for d, count, most in dims:  # a dimension beyond the 64 most frequent has one list a label
        place = F.shiftrightunsigned(F.xxhash64("node", F.lit(1)), 16)
        enough = int(min(1.0, 1.2 * SAMPLE / count) * (1 << 48))  # so that tasks send little more than the sample
        drawn = classes.filter((F.octet_length("x") == size * d) & (place < enough)).orderBy(place).limit(SAMPLE).select("x").collect()
        sample = np.array([np.frombuffer(r.x, kind) for r in drawn], np.float64)
        sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
        pivots[d] = rounded(spread(sample, min(PIVOTS, math.ceil(PER_ROOT * math.sqrt(most)))))
        counts[d] = fitted(sample, _unit(pivots[d]), least) if nearest is None else nearest
    placed = classes.select("node", "n", "label", "x").mapInArrow(K.released(_cells(pivots, counts, least, kind)), f"node long, n long, label {kinds[label_col]}, x binary, cells array<int>, near binary")
    placed = staged(placed, "described")
    placed = placed.withColumn("dim", F.octet_length("x")).select("*", F.posexplode("cells").alias("place", "cell")).withColumn("guest", F.col("place") > 0)
    blocks = lambda c: F.expr(f"cast(({c} + {BLOCK - 1}) div {BLOCK} as int)")
    sizes = placed.groupBy("label", "dim", "cell").agg(F.count_if(~F.col("guest")).alias("homes"), F.count_if("guest").alias("guests")).filter("homes > 0 and homes + guests > 1")
    lists = placed.join(sizes.select("label", "dim", "cell", blocks("homes").alias("hb"), blocks("guests").alias("gb")), ["label", "dim", "cell"])
    # home blocks are numbered from 0, guests' from there; guests meet home blocks only
    dealt = F.xxhash64("node", F.lit(2))
    lists = lists.withColumn("block", F.when(F.col("guest"), F.col("hb") + F.pmod(dealt, F.col("gb"))).otherwise(F.pmod(dealt, F.col("hb"))).cast("int"))
    lists = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("hb") - 1 + F.when(F.col("guest"), 0).otherwise(F.col("gb")))))
    lists = lists.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    units = lists.select(F.xxhash64("label", "dim", "cell", "i", "j").alias("unit"), "node", "n", "x", "near", "block", "i", "j").repartition("unit").sortWithinPartitions("unit")
    links = staged(units.mapInArrow(K.released(_link(least, kind)), "node long, links long, root long"), "links")
    found = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "n", "min_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = named.join(ids, "component").join(degrees, "node", "left").select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
