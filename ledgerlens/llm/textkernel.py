"""Vectorised word and shingle hashing over UTF-8 bytes, for use inside Arrow batches.

A byte-level scan is right for UTF-8 because every separator is an ASCII byte. Hashes depend on fixed
seeds only, so every task, retry and run gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK_BYTES = 1 << 20
#: Texts are hashed together up to so many bytes; working off a group takes some fifty times as much.
GROUP_BYTES = 1 << 18
_MASK = 2**64 - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_DRAWS = np.random.default_rng(20240611)
_BYTE_VALUE = _DRAWS.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_SLOT = _DRAWS.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = frozenset({0x20, *range(0x09, 0x0E)})
#: Words are runs of a-z, 0-9 and everything above ASCII, once A-Z are lower case.
PUNCTUATION = frozenset({*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)})


def inside_table(separators: frozenset[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


IN_WORD = inside_table(BLANK)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def ladder(base: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return ladder(_BASE), ladder(pow(_BASE, -1, 2**64))


#: What a worker keeps: a group's powers and those of twice the size, 13 MB; those of longer texts are built for each.
_kept_powers = lru_cache(maxsize=2)(_powers)


class Hashes:
    """Hashes of any slice of ``data`` in constant time each, from one running sum."""

    def __init__(self, data: bytes):
        self.codes = np.frombuffer(data, dtype=np.uint8)
        size = max(GROUP_BYTES, 1 << len(data).bit_length())
        up, self._down = (_kept_powers if size <= 2 * GROUP_BYTES else _powers)(size + 1)
        self._sum = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.codes] * up[: len(data)], out=self._sum[1:])

    def sums(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What a hash is mixed from: the polynomial of the slice's bytes, which can be continued."""
        return (self._sum[ends] - self._sum[starts]) * self._down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.sums(starts, ends))


def spans(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs whose bytes are all inside."""
    flags = np.zeros(len(codes) + 2, dtype=np.int8)
    flags[1:-1] = inside[codes]
    edges = np.flatnonzero(np.diff(flags))
    return edges[0::2], edges[1::2]


def _cut(data: bytes, start: int, inside: np.ndarray) -> int:
    """The end of a piece of ``CHUNK_BYTES`` and what its last word needs, less than as much again.

    A word that needs more is split before a code point.
    """
    end = start + CHUNK_BYTES
    if end >= len(data):
        return len(data)
    ahead = np.frombuffer(data, dtype=np.uint8, count=min(len(data) - end, CHUNK_BYTES - 1), offset=end)
    outside = np.flatnonzero(~inside[ahead])
    if len(outside):
        return end + int(outside[0])
    end += len(ahead)
    if end < len(data):
        for back in range(4):
            if data[end - back] & 0xC0 != 0x80:
                return end - back
    return end


def word_hashes(data: bytes, inside: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word; long texts and words are worked off in pieces of bounded size."""
    found, start = [], 0
    begun = None  # a word that goes on in the next piece: its sum so far and its start
    while start < len(data):
        end = _cut(data, start, inside)
        piece = Hashes(data[start:end])
        s, e = spans(piece.codes, inside)
        total, s, e = piece.sums(s, e), s + start, e + start
        if begun:
            total[0] = (begun[0] + int(total[0]) * pow(_BASE, start - begun[1], _MASK + 1)) & _MASK
            s[0] = begun[1]
        begun = (int(total[-1]), int(s[-1])) if len(s) and e[-1] == end < len(data) and inside[data[end]] else None
        whole = len(s) - 1 if begun else len(s)
        found.append((mix(total[:whole]), s[:whole], e[:whole]))
        start = end
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def grouped(texts: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts that hold about ``limit`` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def documents_words(texts: list[bytes], inside: np.ndarray = IN_WORD):
    """For each group of texts: first index, joined bytes, word hashes, starts, ends, and each text's word range."""
    for lo, hi in grouped(texts):
        data = b"\n".join(texts[lo:hi])
        h, s, e = word_hashes(data, inside)
        begins = np.zeros(hi - lo + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts[lo:hi]], out=begins[1:])
        yield lo, data, h, s, e, begins, np.searchsorted(s, begins)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k neighbouring words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += h[i : i + n] * _SLOT[i]
    return mix(total)


def short_window(h: np.ndarray) -> np.ndarray:
    """The hash of a whole sequence of fewer than k words."""
    return mix(np.sum(h * _SLOT[: len(h)], keepdims=True) + np.array([len(h)], np.uint64) * _SLOT[15])


def utf8(column) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is the empty text."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
