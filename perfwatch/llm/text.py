"""Vectorised words and hashes of Arrow text columns.

Texts are read from Arrow's own buffers: the bytes of many whole documents at
a time, with one numpy call per step instead of one Python call per word.
Hashes have 64 bits and depend on the bytes alone, so every task, session and
machine gets the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []

#: Bytes that belong to words. Bytes above 0x7F are parts of non-ASCII characters.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and their inverses modulo 2**64, n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        tables = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


class Words:
    """The words of consecutive documents.

    ``hashes``, ``doc``, ``start``, ``end`` have an entry for each word (byte
    positions in ``data``); ``counts`` and ``first`` one for each document.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data, self.offsets = data, offsets
        docs, n = len(offsets) - 1, len(data)
        inside = is_word[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges], after[edges - 1] = False, False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        place = np.searchsorted(self.start, offsets)
        self.first, self.counts = place[:-1], np.diff(place)
        self.doc = np.repeat(np.arange(docs), self.counts)
        powers, inverses = _power_tables(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers[:n], out=total[1:])
        self.hashes = mix((total[self.end] - total[self.start]) * inverses[self.start]) if len(self.start) else np.zeros(0, np.uint64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of up to ``limit`` bytes: (from row, to row, bytes, offsets).

    A longer document is a run of its own. Null texts are empty.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each run of k words; a text of 1 to k-1 words is one run."""
    h, n = words.hashes, len(words.hashes)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    long_docs = words.counts >= k
    whole = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        whole += h[j : j + len(whole)] * factors[j]
    valid = words.doc[: len(whole)] == words.doc[k - 1 :] if n >= k else np.zeros(0, bool)
    short = np.flatnonzero(~long_docs & (words.counts > 0))
    tail = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = words.counts[short] > j
        tail[has] += h[words.first[short][has] + j] * factors[j]
    doc = np.concatenate([words.doc[: len(whole)][valid], short])
    out = mix(np.concatenate([whole[valid], tail]))
    if len(short):
        order = np.argsort(doc, kind="stable")
        doc, out = doc[order], out[order]
    return doc, out


def weighted_elements(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, occurrences) of the distinct shingles of each document, sorted by both."""
    doc, h = shingles(words, k)
    if not len(h):
        return doc, h, np.zeros(0, np.int64)
    edges = np.searchsorted(doc, np.arange(len(words.counts) + 1))
    h = h.copy()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))
