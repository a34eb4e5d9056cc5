"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once per worker.

The tokenizer's words never span white space, nor the border between an ASCII letter and an
ASCII mark other than the apostrophe, so a text's ids are those of its pieces in a row. Pieces
are found and hashed for a whole batch at once; a hash table holds the ids of pieces seen.
``Encoder`` serves tokenizers of that kind (see ``splits``); others are given whole texts.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from millrace.llm import kernel as K

#: Pieces held per worker before the table is begun anew.
HELD = 1_000_000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~", np.uint8)] = True  # not ' nor <|>, of which special tokens are made


class _Table:
    """Piece hash -> place and number of its ids; open addressing, whole arrays at a time, twice as large whenever half full."""

    def __init__(self, bits: int = 16):
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.at = np.zeros(1 << bits, np.int64)
        self.n = np.zeros(1 << bits, np.int32)

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it isn't held; 0 is no hash."""
        slot = self._slots(h)
        key = self.keys[slot]
        out = np.where(key == h, slot, -1)
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            key = self.keys[slot[left]]
            hit = key == h[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """Distinct hashes that aren't held."""
        if 2 * (self.size + len(h)) > 1 << self.bits:
            used = np.flatnonzero(self.keys)
            held = self.keys[used], self.at[used], self.n[used]
            self._empty((2 * (self.size + len(h))).bit_length())
            self._put(*held)
        self._put(h, at, n)

    def _put(self, h: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        slot = self._slots(h)
        left = np.arange(len(h))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = h[free]
            won = free[self.keys[slot[free]] == h[free]]
            self.at[slot[won]], self.n[slot[won]] = at[won], n[won]
            left = left[self.keys[slot[left]] != h[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        self.size += len(h)


#: The normalizers and the words of the tokenizer files whose texts may be encoded in pieces.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits(tokenizer: Tokenizer) -> bool:
    """Whether pieces may be encoded apart, read from the tokenizer's own file.

    That is so where words are runs of letters, single digits, runs of other marks, or an
    apostrophe with its ending, taken out of the text before BPE, and normalizers neither cross
    white space nor look from an ASCII letter to an ASCII mark; and where no added token holds
    white space or a border of a letter and a mark that pieces are cut at.
    """
    told = json.loads(tokenizer.to_str())
    normal, pre, model = told["normalizer"] or {}, told["pre_tokenizer"] or {}, told["model"]
    first, *rest = pre.get("pretokenizers", [{}])
    words = first.get("type") == "Split" and first.get("pattern") == {"Regex": _WORDS} and first.get("behavior") == "Removed" and first.get("invert") is True
    plain = len(rest) == 1 and rest[0].get("type") == "ByteLevel" and not rest[0].get("add_prefix_space") and not rest[0].get("use_regex")
    known = normal.get("normalizers") == _NORMALIZERS and words and plain and model["type"] == "BPE" and not model.get("dropout") and model.get("end_of_word_suffix") == "</w>"
    added = [np.frombuffer(t["content"].encode(), np.uint8) for t in told["added_tokens"]]
    return known and not any(K.SPACE[t].any() or len(_borders(t)) for t in added)


def _borders(data: np.ndarray) -> np.ndarray:
    """Places between an ASCII letter and a mark."""
    letter, mark = _LETTER[data], _MARK[data]
    return np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1


class Encoder:
    _held: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.apart = splits(self.tokenizer)
        self.begin()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per worker process."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def begin(self) -> None:
        self.table = _Table()
        self.ids = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def _learn(self, pieces: list[bytes], hashes: np.ndarray) -> None:
        model = self.tokenizer.model
        texts = [p.decode("utf-8") for p in pieces]
        plain = [t.isascii() and t.isalpha() for t in texts]
        found: list[list[int]] = [[x.id for x in model.tokenize(t.lower())] if p else [] for t, p in zip(texts, plain, strict=True)]
        rest = [i for i, p in enumerate(plain) if not p]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            found[i] = e.ids
        n = np.array([len(f) for f in found], np.int32)
        flat = np.fromiter((i for f in found for i in f), np.uint32, int(n.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.table.add(hashes, self.used + np.cumsum(n) - n, n)
        self.used += len(flat)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids begin, with the end of all."""
        if not self.apart:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.array(x, np.uint32) for x in lists] or [np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        data, offs = K.flat(column)
        bounds, parts, used = np.zeros(len(offs), np.int64), [], 0
        for a, b in K.blocks(data):
            ids, starts, upto = self._block(data[a:b])
            i, j = np.searchsorted(offs, [a, b])
            bounds[i:j] = used + upto[np.searchsorted(starts, offs[i:j] - a)]
            parts.append(ids)
            used += len(ids)
        bounds[np.searchsorted(offs, len(data)) :] = used
        return np.concatenate(parts or [np.zeros(0, np.uint32)]), bounds

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a block of whole words, where its pieces start, and the ids before each piece (with all at the end)."""
        starts, ends, _ = K.words(data, np.zeros(1, np.int64))
        if len(starts) > len(ends):
            ends = np.append(ends, len(data))
        if not len(starts):
            return np.zeros(0, np.uint32), starts, np.zeros(1, np.int64)
        border = _borders(data)
        starts, ends = np.sort(np.concatenate([starts, border])), np.sort(np.concatenate([ends, border]))
        h = K.word_hashes(data, starts, ends) | np.uint64(1)
        slot = self.table.find(h)
        lost = np.flatnonzero(slot < 0)
        at, n = self.table.at[slot], self.table.n[slot].astype(np.int64)
        if len(lost):
            new, first = np.unique(h[lost], return_index=True)
            if self.table.size + len(new) > HELD:
                self.begin()
                new, first = np.unique(h, return_index=True)
                lost = np.arange(len(h))
            raw = data.tobytes()
            self._learn([raw[starts[i] : ends[i]] for i in lost[first]], new)
            slot = self.table.find(h[lost])
            at[lost], n[lost] = self.table.at[slot], self.table.n[slot]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(at - upto[:-1], n) + np.arange(upto[-1])]
        return ids, starts, upto


def with_end(ids: np.ndarray, offs: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text's ids."""
    return np.insert(ids, offs[1:], end), offs + np.arange(len(offs))
