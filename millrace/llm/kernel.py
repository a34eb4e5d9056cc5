"""Vectorised byte kernels over Arrow string columns (NumPy, no row loops).

Texts of a batch are laid end to end, one space after each, and every step below
runs over that whole buffer. Hashes are polynomial prefix sums modulo 2**64,
finalised by a bit mixer; they depend on content only, never on place.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
#: Bytes of text handled at once; a longer text is handled alone.
SLICE = 1 << 19
#: Bytes over which word hashes are worked at once, so that the arrays beside a text don't grow with it.
BLOCK = 1 << 18
_tables: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same for ``mapInArrow``, but what a task has freed goes back to the system at its end: idle workers stay small."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p**i and p**-i modulo 2**64 for i < n at least."""
    if len(_tables[0]) < n:
        size = 1 << max(19, (n - 1).bit_length())
        for k, base in enumerate((_P, _PINV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _tables[k] = np.multiply.accumulate(x)
    return _tables[0], _tables[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def flat(column: pa.Array, tail: str = " ") -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end, each followed by ``tail`` (null: empty); and where each begins, with the end of all."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if tail:
        column = pc.binary_join_element_wise(column, pa.scalar("", pa.large_string()), pa.scalar(tail, pa.large_string()))
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8, offs[-1] - offs[0], offs[0]) if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(data: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end after white space (or at the end), so no word is cut."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and not SPACE[data[end - 1]]:
            gap = np.flatnonzero(SPACE[data[end : end + size]])
            end = end + int(gap[0]) + 1 if len(gap) else min(end + size, len(data))
        yield at, end
        at = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, by content."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs of other than white space, and the first word of each text (with the end of all)."""
    ws = SPACE[data]
    edges = np.flatnonzero(ws[1:] != ws[:-1]) + 1
    if len(ws) and not ws[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word by content, the same as ``range_hash``; worked in blocks of about BLOCK bytes, cut between words."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
        a = starts[at]
        prefix = prefix_hash(data[a : ends[end - 1]])
        out[at:end] = range_hash(prefix, starts[at:end] - a, ends[at:end] - a)
        at = end
    return out


_C = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3)]


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k words in a row; those that span two texts are the caller's to leave out."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _C[0] + hashes[j : j + n] * _C[1 + j % 7]
    return mix(out)


def short_shingle(hashes: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words than a shingle has."""
    x = np.full(1, 0x5851F42D4C957F2D + len(hashes), np.uint64)
    for h in hashes:
        x = mix(x * _C[0] + h)
    return x
