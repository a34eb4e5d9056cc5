"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts anywhere else.

Shards. Each window of ``length`` bytes is named by the least hash of its 32-byte grams; a
run of windows of one name is a segment. Equal windows have equal names, so the windows of
one name can be settled apart from all others. Names seen once (and without a repeat inside)
are done; equal segments of a name repeat as a whole; only the different segments of a name
are laid end to end in shards, whose suffix arrays are induced and whose permuted common
prefixes tell which windows repeat. A name with very many different segments is settled by
counting its windows' hashes instead, which combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import kernel as K
from millrace.llm.common import drop_staged, row_key, staged
from millrace.llm.suffixes import common_prefixes, suffix_array

_GRAM = 32
#: Different segments of one name, and bytes of them, beyond which its windows are counted by hash: a task holds no more of a name.
WIDE, WIDE_BYTES = 4096, 2_000_000
#: Bytes of a shard; bytes whose windows are named at once, so that the arrays beside a long text don't grow with it.
SHARD, PIECE = 500_000, 1 << 17


def _window_hash(data: np.ndarray, size: int) -> np.ndarray:
    """A hash at each position of the ``size`` bytes from there; size is a power of two."""
    h, w, p = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while w < size:
        h = h[:-w] * np.uint64(pow(p, w, 1 << 64)) + h[w:]
        w *= 2
    return K.mix(h)


def _sliding(x: np.ndarray, size: int, f) -> np.ndarray:
    w = 1
    n = len(x) - size + 1
    while w * 2 <= size:
        x = f(x[:-w], x[w:])
        w *= 2
    return f(x[:n], x[size - w : size - w + n])


def _segments(length: int):
    span = length - _GRAM + 1

    names = ["key", "start", "n", "name", "seg", "self"]

    def piece(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Segments of a run of bytes whose windows start in the ranges [lo, hi): starts, ends, names, hashes, and whether a name may be held twice."""
        grams = _window_hash(data, _GRAM)
        least = _sliding(grams, span, np.minimum)
        edge = np.zeros(len(least) + 1, np.int8)
        edge[lo] += 1
        edge[hi] -= 1
        valid = np.cumsum(edge[:-1]).astype(bool)
        change = np.concatenate([[True], least[1:] != least[:-1]])
        # documents end between windows, so neighbours of two documents are never both valid
        starts = np.flatnonzero(valid & (change | ~np.concatenate([[False], valid[:-1]])))
        ends = np.flatnonzero(valid & (np.concatenate([change[1:], [True]]) | ~np.concatenate([valid[1:], [False]]))) + 1

        reach = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum)
        at = np.flatnonzero(reach == grams)
        order = np.argsort(grams[at], kind="stable")
        h, p = grams[at][order], at[order]
        again = h[1:][(h[1:] == h[:-1]) & (p[1:] - p[:-1] <= span)]
        return starts, ends, least[starts], K.range_hash(K.prefix_hash(data), starts, ends + length - 1), np.isin(least[starts], again)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = K.flat(batch.column("text"), "")
        key = batch.column("key").to_numpy(zero_copy_only=False)
        first, end = offs[:-1], offs[1:] - length + 1
        long = np.flatnonzero(end > first)
        first, end = first[long], end[long]
        for a in range(0, len(data) - length + 1, PIECE):
            i, j = np.searchsorted(end, a, "right"), np.searchsorted(first, a + PIECE)
            if i == j:
                continue
            lo, hi = np.maximum(first[i:j] - a, 0), np.minimum(end[i:j] - a, PIECE)
            starts, ends, name, seg, twice = piece(data[a : a + PIECE + length - 1], lo, hi)
            doc = long[np.searchsorted(first, starts + a, "right") - 1]
            cols = [key[doc], starts + a - offs[doc], ends - starts, name.view(np.int64), seg.view(np.int64), twice]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            yield from cut(batch)

    return run


def _slice(length: int):
    """Rows (key, text, parts) -> a row for each part, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            data, offs = K.flat(batch.column("text"), "")
            rows = []
            for i, (key, parts) in enumerate(zip(batch.column("key").to_pylist(), batch.column("parts").to_pylist(), strict=True)):
                rows += [(p["name"], key, p["start"], p["n"], p["single"], data[offs[i] + p["start"] : offs[i] + p["start"] + p["n"] + length - 1].tobytes()) for p in parts]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["name", "key", "start", "n", "single", "bytes"])

    return run


def _shard(length: int):
    """Rows in order of name -> the ranges of windows that repeat, of segments that are single."""

    def settle(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        blobs = [x.as_buffer() for x in batch.column("bytes").combine_chunks()]
        offs = np.concatenate([[0], np.cumsum([len(b) + 1 for b in blobs])])
        data = np.frombuffer(b"\xff".join(blobs) + b"\xff", np.uint8)  # a byte that UTF-8 has not
        sa = suffix_array(data)
        prefix = common_prefixes(data, sa, length)
        repeats = prefix >= length
        after = np.flatnonzero(repeats[sa])
        repeats[sa[after - 1]] = True  # the first of each set of equal windows
        which = np.searchsorted(offs, np.arange(len(data)), "right") - 1
        start = np.arange(len(data)) - offs[which]
        repeats &= (start + length < np.diff(offs)[which]) & batch.column("single").to_numpy()[which]
        edge = np.diff(np.concatenate([[0], repeats.astype(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(a):
            row = which[a]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("key").to_numpy()[row]), pa.array(batch.column("start").to_numpy()[row] + a - offs[row]), pa.array(b - a)], ["key", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[pa.RecordBatch] = []  # rows of names that have ended
        last: list[pa.RecordBatch] = []  # rows of the name at hand
        now, size = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name").to_numpy()
            firsts = np.flatnonzero(names[1:] != names[:-1]) + 1
            firsts = firsts if now == names[0] else np.concatenate([[0], firsts])
            now = names[-1]
            if not len(firsts):
                last.append(batch)
                continue
            b = int(firsts[-1])
            whole += [*last, batch.slice(0, b)]
            size = sum(x.column("bytes").nbytes for x in whole)
            last = [batch.slice(b)]
            if size >= SHARD and sum(x.num_rows for x in whole):
                yield from settle(pa.Table.from_batches(whole))
                whole, size = [], 0
        if whole or last:
            yield from settle(pa.Table.from_batches(whole + last))

    return run


def _windows(length: int):
    """Each window of each segment by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "bytes", PIECE):
            column = batch.column("bytes")
            _, offs, data = column.buffers()
            offs = np.frombuffer(offs, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
            data, offs = np.frombuffer(data, np.uint8, offs[-1] - offs[0], offs[0]), offs - offs[0]
            n = np.diff(offs) - length + 1
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(offs[:-1], n) + within
            row = np.repeat(np.arange(len(n)), n)
            h = K.range_hash(K.prefix_hash(data), at, at + length).view(np.int64)
            name, key, start, single = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("name", "key", "start", "single"))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (name, key, start + within, single, h)], ["name", "key", "start", "single", "w"])

    return run


def repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``key, start, n``: windows of ``length`` bytes that occur elsewhere too, as ranges of their starts; key as by ``row_key``."""
    base = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    every = staged(base.mapInArrow(K.released(_segments(length)), "key long, start long, n long, name long, seg long, self boolean"), "segments")
    often = every.groupBy("name").agg(F.count("*").alias("c"), F.max("self").alias("self")).filter("c > 1 or self").select("name")
    found = staged(every.drop("self").join(often, "name"), "segments", rows=every.count())
    drop_staged(every)
    segs = found.groupBy("name", "seg", "n").agg(F.count("*").alias("c"), F.min(F.struct("key", "start")).alias("at"))
    names = segs.groupBy("name").agg(F.count("*").alias("different"), F.sum(F.col("n") + length).alias("size"))
    names = names.select("name", "different", F.expr(f"different > {WIDE} or size > {WIDE_BYTES}").alias("wide"))
    segs = staged(segs.join(names.drop("wide"), "name"), "names", rows=found.count())
    copies = found.join(segs.filter("c > 1").select("name", "seg", "n"), ["name", "seg", "n"]).select("key", "start", "n")

    # a lone segment of a name is there for a repeat inside it
    parts = segs.filter("different > 1 or c = 1").select("at.key", F.struct("name", "at.start", "n", (F.col("c") == 1).alias("single"), "different").alias("p"))
    parts = parts.groupBy("key").agg(F.collect_list("p").alias("parts"))
    texts = base.join(parts, "key").dropDuplicates(["key"])
    cols = "name long, key long, start long, n long, single boolean, bytes binary"
    bytes_ = staged(texts.mapInArrow(K.released(_slice(length)), cols).join(names.filter("wide").select("name", "wide"), "name", "left"), "bytes")
    narrow = bytes_.filter("wide is null").drop("wide").repartition("name").sortWithinPartitions("name")
    settled = narrow.mapInArrow(K.released(_shard(length)), "key long, start long, n long")
    windows = bytes_.filter("wide").drop("wide").mapInArrow(K.released(_windows(length)), "name long, key long, start long, single boolean, w long")
    more = windows.groupBy("name", "w").agg(F.count("*").alias("c")).filter("c > 1").select("name", "w")
    wide = windows.join(more, ["name", "w"]).filter("single").select("key", "start", F.lit(1).cast("long").alias("n"))
    return copies.unionByName(settled).unionByName(wide)


def _cut(length: int, first: str, names: list[str], digest: bool):
    """Rows (``first``, text, parts) -> ``first``, then bytes, bytes removed and spans with the digest of what is left, or what is left."""

    def spans(parts: list | None) -> list[list[int]]:
        out: list[list[int]] = []
        for p in sorted((p["start"], p["start"] + p["n"] + length - 1) for p in parts or []):
            if out and p[0] <= out[-1][1]:
                out[-1][1] = max(out[-1][1], p[1])
            else:
                out.append(list(p))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            counts, left = [], []
            for text, parts in zip(batch.column("text"), batch.column("parts").to_pylist(), strict=True):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                cuts = spans(parts)
                at, kept = 0, []
                for a, b in cuts:
                    kept.append(bytes(raw[at:a]))
                    at = b
                kept.append(bytes(raw[at:]))
                counts.append((len(raw), sum(b - a for a, b in cuts), len(cuts)))
                if digest:
                    left.append(hashlib.sha256(b"".join(kept)).hexdigest())
                else:
                    left.append("".join(k.decode("utf-8", "ignore") for k in kept) if text.is_valid else None)
            own = [pa.array(x, pa.int64()) for x in zip(*counts, strict=True)] if digest else []
            yield pa.RecordBatch.from_arrays([batch.column(first), *own, pa.array(left, pa.string())], names)

    return run


def _with_parts(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """Rows (key, text, ..) with the ranges of repeated windows of their key."""
    found = repeated_windows(docs, id_col=id_col, text_col=text_col, length=length)
    lists = found.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("parts"))
    return rows.join(lists, "key", "left").drop("key")


def removal_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans, kept_sha256``.

    Texts count as UTF-8 bytes; strings are judged on the input and their overlaps add up.
    Null and empty texts have no bytes and lose none. Repeated rows repeat each other and
    so lose all that is ``length`` bytes or longer. Other columns are ignored.
    """
    base = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    run = _cut(length, "id", ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], True)
    return _with_parts(base, docs, id_col, text_col, length).mapInArrow(K.released(run), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """The input's rows and columns, whatever they are called, with repeated bytes gone from the text.

    A character that a cut leaves in part goes as well. A null text stays null.
    """
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    left = _with_parts(rows, docs, id_col, text_col, length).mapInArrow(K.released(_cut(length, "row", ["row", "text"], False)), schema)
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
