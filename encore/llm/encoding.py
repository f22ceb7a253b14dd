"""Token ids of whole texts with the ``tokenizers`` library.

A byte-level BPE tokenizer cuts a text into pre-tokens that are encoded
independently. Texts are cut here only where a pre-token must begin: before
white space that a visible character follows, after such a line break, and
between a letter and a closing mark. Each distinct cut is encoded once by the
library and kept under its 64-bit hash with its bytes; texts are then put together
from the kept ids. Bytes are compared on every hit; should two cuts ever share a
hash, the texts at hand are encoded whole. A text that holds one of the tokenizer's added tokens (as <|endoftext|>)
isn't cut: the library, by its default, makes the literal token its id, and what
stands beside it is cut differently. ``literal`` encodes special tokens in
content as ordinary text (for chat turns). Tests compare this with the library on
whole texts.
"""

from __future__ import annotations

import os

import numpy as np

from encore.llm import wordhash as wh
from encore.llm.common import pieces

# distinct cuts kept by a worker (some 40 bytes each); beyond it starts anew
KEPT_CUTS = 2_000_000
# and their ids and bytes (by eights), since a whole text may be one cut
KEPT_IDS = 1 << 24
KEPT_LANES = 1 << 23

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# bytes that surely begin a visible character: printable ASCII, and lead bytes
# of blocks without any space character
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xE1] = True
_VISIBLE[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True


class Encoder:
    """Encodes buffers of texts; one per worker process, tokenizer file and ``literal``."""

    _made: dict[tuple[str, bool], "Encoder"] = {}

    def __init__(self, path: str, literal: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()
                      if not (literal and t.special)]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self._forget()

    @classmethod
    def at(cls, path: str, literal: bool = False) -> "Encoder":
        if (path, literal) not in cls._made:
            cls._made[path, literal] = cls(path, literal)
        return cls._made[path, literal]

    def _forget(self) -> None:
        # (sorted hashes, id starts, id counts, lane starts, bytes) of an old large and a new small part
        self.parts = [(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4)] * 2
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.lanes, self.lanes_used = np.empty(1 << 16, np.uint64), 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Id start (-1: not kept), id count, lane start and bytes of each hash."""
        found = tuple(np.full(len(hashes), -1, np.int64) for _ in range(4))
        for keys, *kept in self.parts:
            if len(keys):
                at = np.searchsorted(keys, hashes)
                at[at == len(keys)] = 0
                hit = keys[at] == hashes
                for out, values in zip(found, kept):
                    out[hit] = values[at[hit]]
        return found

    def _room(self, name: str, used: int, more: int) -> np.ndarray:
        have = getattr(self, name)
        while used + more > len(have):
            have = np.concatenate([have, np.empty(len(have), have.dtype)])
        setattr(self, name, have)
        return have

    def _learn(self, hashes: np.ndarray, texts: list[str], lanes: np.ndarray, n_lanes: np.ndarray, sizes: np.ndarray) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        total = int(counts.sum())
        self._room("ids", self.used, total)[self.used:self.used + total] = np.fromiter((i for e in found for i in e), np.uint32, total)
        self._room("lanes", self.lanes_used, len(lanes))[self.lanes_used:self.lanes_used + len(lanes)] = lanes
        starts = self.used + np.cumsum(counts) - counts
        lane_starts = self.lanes_used + np.cumsum(n_lanes) - n_lanes
        self.used, self.lanes_used = self.used + total, self.lanes_used + len(lanes)
        old, new = self.parts
        new = self._merged(new, (hashes, starts, counts, lane_starts, sizes))
        if 4 * len(new[0]) > len(old[0]):
            old, new = self._merged(old, new), tuple(x[:0] for x in new)
        self.parts = [old, new]

    @staticmethod
    def _merged(a, b):
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and each row's offset in them."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for lo, hi in pieces(offsets):
            a, b = self._encode_piece(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            ids.append(a)
            counts.append(b)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Rows that may hold an added token."""
        rows = np.zeros(len(offsets) - 1, bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                rows[row] = True
                at = raw.find(token, int(offsets[row + 1]))
        return rows

    def _encode_piece(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if len(data) == 0:
            return np.empty(0, np.uint32), np.zeros(rows, np.int64)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        space, visible = _SPACE[data], _VISIBLE[data]
        cut = np.zeros(len(data) + 1, bool)
        follows = space[:-1] & visible[1:] & ~first[1:-1]  # white space, then a visible character of the same row
        cut[:-2] = follows
        cut[1:-1] |= follows & (data[:-1] != 0x20)
        cut[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        raw = data.tobytes()
        whole = self._with_added(raw, offsets)
        if whole.any():
            cut[:-1] &= ~np.repeat(whole, np.diff(offsets))
        cut |= first
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        sizes = ends - starts
        lanes, number, first_lane = wh.lanes(data, starts, ends)
        hashes = self._hashes(lanes, number, first_lane, sizes)
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if not _equal(lanes, first_lane[:-1], sizes, lanes, first_lane[at[back]], sizes[at[back]]):
            return self._plainly(raw, offsets)
        if len(self.parts[0][0]) + len(self.parts[1][0]) > KEPT_CUTS or self.used > KEPT_IDS or self.lanes_used > KEPT_LANES:
            self._forget()
        start, count, kept_lane, kept_size = self._find(distinct)
        old, new = np.flatnonzero(start >= 0), np.flatnonzero(start < 0)
        if not _equal(lanes, first_lane[at[old]], sizes[at[old]], self.lanes, kept_lane[old], kept_size[old]):
            return self._plainly(raw, offsets)
        if len(new):
            n_lanes = np.diff(first_lane)[at[new]]
            own = np.repeat(first_lane[at[new]] - np.cumsum(n_lanes) + n_lanes, n_lanes) + np.arange(n_lanes.sum())
            a, b = starts[at[new]].tolist(), ends[at[new]].tolist()
            self._learn(distinct[new], [raw[x:y].decode() for x, y in zip(a, b)], lanes[own], n_lanes, sizes[at[new]])
            start[new], count[new] = self._find(distinct[new])[:2]
        start, count = start[back], count[back]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(start - total[:-1], count) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    @staticmethod
    def _hashes(lanes: np.ndarray, number: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return wh.lane_hashes(lanes, number, first, sizes, 9)

    def _plainly(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole texts by the library alone."""
        ends = offsets.tolist()
        found = [e.ids for e in self.tokenizer.encode_batch_fast(
            [raw[a:b].decode() for a, b in zip(ends[:-1], ends[1:])], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for e in found for i in e), np.uint32, int(counts.sum())), counts


def _equal(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> bool:
    """Whether all pairs of spans, given by first lane and bytes, hold the same bytes."""
    if not np.array_equal(a_size, b_size):
        return False
    n = (a_size + 7) >> 3
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return bool((a[np.repeat(a_at, n) + within] == b[np.repeat(b_at, n) + within]).all())
