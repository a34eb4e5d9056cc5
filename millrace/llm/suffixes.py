"""Suffix arrays by induced sorting and permuted common prefixes, vectorised with NumPy.

Each bucket of the alphabet is handled as a whole: what it induces is found, dealt out to
its buckets in a stable order and appended there, so one pass costs a few array operations
per bucket and per run of equal bytes. The reduced string of leftmost-S names is sorted by
recursive renaming of pairs (its alphabet is as large as the string, so buckets would not pay).
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is S: smaller than the next one. The last is L (a sentinel follows it)."""
    n = len(s)
    out = np.zeros(n, bool)
    if n > 1:
        step = np.sign(s[1:].astype(np.int16) - s[:-1].astype(np.int16))
        at = np.flatnonzero(step)
        nxt = np.searchsorted(at, np.arange(n - 1))
        known = nxt < len(at)
        out[:-1][known] = step[at[nxt[known]]] > 0
    return out


def _append(sa: np.ndarray, head: np.ndarray, pos: np.ndarray, chars: np.ndarray, back: bool) -> None:
    """Put positions into the buckets of their bytes, in order: upwards from head, or downwards."""
    if not len(pos):
        return
    order = np.argsort(chars, kind="stable")
    c = chars[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[head[c] - 1 - rank if back else head[c] + rank] = pos[order]
    head[c[first]] += -size if back else size


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All suffixes, induced from the given order of the leftmost S ones."""
    n = len(s)
    sa = np.empty(n, np.int32)
    lower, upper = starts[:-1], starts[1:]
    by_char = np.argsort(s[lms], kind="stable")
    lms = lms[by_char]
    cut = np.searchsorted(s[lms], np.arange(257))
    used = np.flatnonzero(upper > lower)

    head = lower.copy()
    last = np.array([n - 1])
    _append(sa, head, last, s[last], False)  # the sentinel induces the last suffix
    for c in used:
        lo = lower[c]
        while lo < head[c]:
            now = sa[lo : head[c]].astype(np.int64)
            lo = head[c]
            now = now[now > 0] - 1
            now = now[~is_s[now]]
            _append(sa, head, now, s[now], False)
        now = lms[cut[c] : cut[c + 1]].astype(np.int64)
        now = now[now > 0] - 1
        _append(sa, head, now, s[now], False)  # what precedes a leftmost S suffix is L

    tail = upper.copy()
    for c in used[::-1]:
        hi = upper[c]
        while hi > tail[c]:
            now = sa[tail[c] : hi][::-1].astype(np.int64)
            hi = tail[c]
            now = now[now > 0] - 1
            now = now[is_s[now]]
            _append(sa, tail, now, s[now], True)
        now = sa[lower[c] : head[c]][::-1].astype(np.int64)
        now = now[now > 0] - 1
        now = now[is_s[now]]
        _append(sa, tail, now, s[now], True)
    return sa


def _names(s: np.ndarray, is_s: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost S substrings in text order, equal where the substrings are; order: them sorted."""
    n = len(s)
    nxt = np.full(n, n, np.int64)
    nxt[lms[:-1]] = lms[1:]
    a, b = order[:-1], order[1:]
    la, lb = nxt[a] - a, nxt[b] - b
    same = (la == lb) & (nxt[a] < n) & (nxt[b] < n)
    at = np.flatnonzero(same)
    k = 0
    while len(at):
        i, j = a[at] + k, b[at] + k
        differ = s[i] != s[j]
        same[at[differ]] = False
        at = at[~differ]
        at = at[la[at] > k]
        k += 1
    rank = np.cumsum(np.concatenate([[0], ~same]))
    out = np.empty(n, np.int64)
    out[order] = rank
    return out[lms]


def _sort_names(names: np.ndarray) -> np.ndarray:
    """The suffix array of a string of ranks: pairs of names at doubling distance are renamed until all differ."""
    n, rank, step = len(names), names, 1
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        step *= 2
    return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Of a byte string, as 32-bit positions; a shorter suffix that begins a longer one comes first."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=256))]).astype(np.int64)
    is_s = _types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) > 1:
        rough = _induce(s, is_s, lms, starts)
        flag = np.zeros(n, bool)
        flag[lms] = True
        order = rough[flag[rough]].astype(np.int64)
        lms = lms[_sort_names(_names(s, is_s, order, lms))]
    return _induce(s, is_s, lms, starts)


def common_prefixes(s: np.ndarray, sa: np.ndarray, least: int) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the array; of values over ``least``, that or more.

    A value whose preceding byte equals its partner's is one less than the value before it;
    only the others, and one in every 3 * ``least``, are compared byte by byte, 4 * ``least`` bytes at most.
    """
    most = 4 * least
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n)
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] > 0) & (phi[:-1] >= 0)
    at = np.flatnonzero(reducible)
    reducible[at] = (s[at - 1] == s[phi[at] - 1]) & (phi[at - 1] == phi[at] - 1)
    reducible[:: 3 * least] = False
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(~reducible & (phi >= 0))
    k = 0
    while len(at) and k < most:
        fits = (at + k < n) & (phi[at] + k < n)
        at = at[fits]
        at = at[s[at + k] == s[phi[at] + k]]
        k += 1
        out[at] = k
    own = np.flatnonzero(~reducible)
    last = own[np.searchsorted(own, i, "right") - 1]
    return np.maximum(out[last] - (i - last), 0)
