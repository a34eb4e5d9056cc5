"""Order-preserving packing: window cuts by dynamic programming with a monotone queue.

Documents in order of id are one stream of token ids, dealt out by ranges of ids. A cut may
fall at a document's end, at a sentence's end (SENTENCE) or, where neither is near, inside a
sentence (INSIDE). The cost of a window is its padding and its cut's penalty:
f(j) = penalty(j) + N - c(j) + min over c(j) - c(i) <= N of (f(i) + c(i)), a sliding minimum.
A window of a power of two is not padded but costs SHORT. The programme runs over HORIZON
tokens at a time: all its windows but the last stand, and the next run begins after them; so
cuts depend on a range's documents alone, and memory on neither range nor document. A range's
last tokens are cut into windows of powers of two from LEAST_POWER on, and one that is padded.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernel as K
from millrace.llm.common import ranges_for
from millrace.llm.tokens import Encoder, with_end

SENTENCE, INSIDE, SHORT = 8, 64, 48
HORIZON, LEAST_POWER = 1 << 19, 256
#: Tokens after which a stretch without document or sentence ends may be cut inside.
STRETCH = 256


def choose_cuts(cuts: np.ndarray, penalty: np.ndarray, size: int) -> np.ndarray:
    """Of rising cut positions from 0, gaps at most ``size``, those of least cost, the first and last included."""
    short = [[] for _ in range(len(cuts))]
    k = LEAST_POWER
    while k < size:
        at = np.searchsorted(cuts, cuts - k)
        for j in np.flatnonzero((cuts >= k) & (cuts[at] == cuts - k)).tolist():
            short[j].append(int(at[j]))
        k *= 2
    c, pen = cuts.tolist(), penalty.tolist()
    cost, came = [0.0] * len(c), [0] * len(c)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(c)):
        at = c[j]
        while at - c[queue[0][1]] > size:
            queue.popleft()
        best, i = queue[0]
        best += size - at
        for s in short[j]:
            if cost[s] + SHORT < best:
                best, i = cost[s] + SHORT, s
        best += pen[j]
        cost[j], came[j] = best, i
        g = best + at
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, j))
    out, j = [], len(c) - 1
    while j:
        out.append(c[j])
        j = came[j]
    return np.array([0, *out[::-1]], np.int64)


def candidates(ids: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, from 0 to its end, and the penalties."""
    penalty = np.full(len(ids) + 1, -1, np.int16)
    sentence = np.flatnonzero(np.isin(ids, marks)) + 1
    penalty[sentence] = SENTENCE
    penalty[ends] = 0
    penalty[0] = penalty[-1] = 0
    at = np.flatnonzero(penalty >= 0)
    gap = np.diff(at)
    for a, g in zip(at[:-1][gap > STRETCH].tolist(), gap[gap > STRETCH].tolist(), strict=True):
        inner = np.arange(a + STRETCH, a + g, STRETCH)
        penalty[inner] = INSIDE
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at].astype(np.float64)


def _tail(total: int) -> list[int]:
    """Windows of a range's last tokens: falling powers of two, then what is less than LEAST_POWER."""
    found = [1 << b for b in range(total.bit_length() - 1, LEAST_POWER.bit_length() - 2, -1) if total >> b & 1]
    return found + [total % LEAST_POWER] * (total % LEAST_POWER > 0)


def _pack(path: str, end: int, size: int, sentence_marks: tuple[str, ...], with_ids: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        marks = np.array([e.ids[0] for e in encoder.tokenizer.encode_batch(list(sentence_marks), add_special_tokens=False) if len(e.ids) == 1], np.uint32)
        sequence = TaskContext.get().partitionId() << 33
        kind = None
        # what is held back: ids, and per document its id, all its tokens, its tokens before these, its end here
        held = np.zeros(0, np.uint32)
        doc: list = []
        total, before, ends = (np.zeros(0, np.int64) for _ in range(3))

        def pieces(windows: np.ndarray) -> pa.RecordBatch:
            """Of the ids held up to the last window's end."""
            nonlocal sequence
            last = windows[-1]
            bounds = np.unique(np.concatenate([windows, ends[ends < last]]))
            a, b = bounds[:-1], bounds[1:]
            d = np.searchsorted(ends, a, "right")
            first = np.concatenate([[0], ends[:-1]])[d]
            w = np.searchsorted(windows, a, "right") - 1
            raw = [held[i:j].astype("<u4").tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
            cols = [pa.array([doc[i] for i in d.tolist()], kind), pa.array(before[d] + a - first), pa.array(b - a), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(total[d]), pa.array(sequence + w), pa.array(a - windows[w])]
            sequence += len(windows) - 1
            return pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * with_ids, names)

        def drop(at: int) -> None:
            nonlocal held, doc, total, before, ends
            d = int(np.searchsorted(ends, at, "right"))
            first = np.concatenate([[0], ends[:-1]])[d:]
            before = before[d:] + np.maximum(at - first, 0)
            held, doc, total, ends = held[at:], doc[d:], total[d:], ends[d:] - at

        for batch in K.slices(batches, "text"):
            kind = batch.column("id").type
            ids, offs = with_end(*encoder.encode(batch.column("text")), end)
            ends = np.concatenate([ends, offs[1:] + len(held)])
            held = np.concatenate([held, ids.astype(np.uint32)])
            doc = doc + batch.column("id").to_pylist()
            total = np.concatenate([total, np.diff(offs)])
            before = np.concatenate([before, np.zeros(len(offs) - 1, np.int64)])
            while len(held) >= HORIZON:
                windows = choose_cuts(*candidates(held[:HORIZON], ends[ends <= HORIZON], marks), size)
                yield pieces(windows[:-1])
                drop(int(windows[-2]))
        if len(held):
            windows = choose_cuts(*candidates(held, ends, marks), size)
            if len(windows) > 2:
                yield pieces(windows[:-1])
                drop(int(windows[-2]))
            yield pieces(np.concatenate([[0], np.cumsum(_tail(len(held)))]))

    return run


def pack(docs: DataFrame, tokenizer: str, *, end: int = 2, size: int = 4096, id_col: str = "doc_id", text_col: str = "text", sentence_marks: tuple[str, ...] = (".", "!", "?"), with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``, 32-bit little-endian).

    A document is the ids of its whole text by the tokenizer file, and ``end``; a null or
    empty text is the end id alone. Each id is in exactly one piece, pieces follow each
    other in order of (id, text) within a sequence of at most ``size`` ids, and sequences
    follow each other within a range of rows; ranges are as many as the texts' bytes ask for.
    Repeated rows are packed as often as they occur; null ids come first. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    parts = ranges_for(base.agg(F.sum(F.octet_length("text"))).first()[0])
    # rows of one id, and even of one text, may fall into several ranges
    order = [F.col("id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    ranged = base.repartitionByRange(parts, *order).sortWithinPartitions("id", F.xxhash64("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return ranged.mapInArrow(K.released(_pack(tokenizer, end, size, sentence_marks, with_ids, names)), schema)
