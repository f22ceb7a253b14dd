"""Vectorised words, word hashes and window hashes over UTF-8 byte buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D; these
separators are ASCII, so working on bytes equals working on characters.
Word hashes are 64-bit polynomials over per-byte random values, then mixed;
a window's hash is a polynomial over mixed word hashes. All arithmetic is
modulo 2**64 with odd bases, which have inverses, so any span's hash comes
from two prefix sums. Such polynomials are equal for some long regular texts (two
complementary Thue-Morse strings of 1,024 units whatever the base), so they serve
features of classifiers only. Where equality decides a result, ``lane_hashes`` and
``window_hashes`` scramble every 8 bytes, and every joining of two halves, before adding.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_BYTE_VALUE = np.random.default_rng(20240).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xC2B2AE3D27D4EB4F, "check": 0xD6E8FEB86659FD93}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        out = []
        for base in (_BASES[kind], pow(_BASES[kind], -1, 2**64)):
            p = np.empty(size, np.uint64)
            p[0] = 1
            p[1:] = np.uint64(base)
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 1 << 22:
            _POWERS[kind] = have
    return have


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span."""
    power, inverse = _powers(kind, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per row the number of its first
    word (one more entry at the end). ``offsets`` start at 0."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~SEPARATOR[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start[first] = word[first]
    last = word.copy()
    last[:-1] &= ~word[1:] | start[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(span_hashes(_BYTE_VALUE[data], starts, ends, "byte") + (ends - starts).astype(np.uint64))


def lanes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans' bytes as 64-bit lanes counted from each span's start (the last one
    filled up with zeros), each lane's number in its span, and per span the number of
    its first lane (one more entry at the end). Equal lanes and sizes are equal bytes."""
    size = ends - starts
    n = (size + 7) >> 3
    first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    number = np.arange(first[-1]) - np.repeat(first[:-1], n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.repeat(starts, n) + 8 * number]
    values = np.ascontiguousarray(eight).view("<u8").ravel().astype(np.uint64, copy=False)
    left = np.repeat(size, n) - 8 * number
    short = np.flatnonzero(left < 8)
    values[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
    return values, number, first


def lane_hashes(values: np.ndarray, number: np.ndarray, first: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each span (none is empty) from its lanes and size in bytes."""
    if len(sizes) == 0:
        return np.empty(0, np.uint64)
    scrambled = mix(values ^ mix(number.astype(np.uint64), 21 + seed), 22 + seed)
    return mix(np.add.reduceat(scrambled, first[:-1]) + sizes.astype(np.uint64), 23 + seed)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words by which they are told apart."""
    return lane_hashes(*lanes(data, starts, ends), ends - starts)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of words[i:i+size] for every i at which that many words are left: halves
    are joined by doubling, each time scrambled."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)

    def joined(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
        m = min(len(a), len(b))
        return mix(a[:m] * np.uint64(_BASES["word"]) + b[:m], seed + 31 + width)

    level, width, whole, covered, left = mix(words, seed + 30), 1, None, 0, size
    while left:
        if left & 1:
            whole = level if whole is None else joined(whole, level[covered:], covered)
            covered += width
        left >>= 1
        if left:
            level, width = joined(level, level[width:], width), 2 * width
    return whole[:n]


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row number of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in ``among`` (sorted): a bitmap first, then a search."""
    found = np.zeros(len(values), bool)
    if len(among) == 0 or len(values) == 0:
        return found
    bits = max(16, int(len(among)).bit_length() + 4)
    seen = np.zeros(1 << bits, bool)
    seen[(among >> np.uint64(64 - bits)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(values >> np.uint64(64 - bits)).astype(np.int64)])
    at = np.searchsorted(among, values[maybe])
    at[at == len(among)] = 0
    found[maybe] = among[at] == values[maybe]
    return found
