"""Substring dedup: words covered by a repeated window of words.

Seed and extend. Seeds are winnowed anchors: of the k-word grams inside each
window of ``window`` words the one with the smallest hash, so equal windows
always choose the same anchor at the same place. Anchors are joined over the
whole corpus; where an anchor occurs more than once, each occurrence is
extended to the left and right to the windows that chose it, and the
extensions are matched by a 128-bit hash of their words. Overlapping matched
windows merge into maximal repeats, all at least ``window`` words long, and
the covered words are removed.

Scale: rows are dealt to blocks by the hash of (id, text, place in the input),
so that even a row repeated without end in one file fills no block. A block sends each
distinct anchor or window once, with its count, so a passage shared by a third
of all documents costs one row per block, not one per copy, and no group is
ever larger than the number of blocks. The text itself is shuffled once (the
exchange is reused by the three passes over it).

Cases: null text has no words; fewer than ``window`` words hold no window;
repeated rows are separate documents (so their windows repeat); null and
repeated ids are kept as they are; other columns are dropped unless named in
``carry``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm import wordhash as wh
from encore.llm.common import block_of, blocks_for, byte_buffer, pieces, string_array

WINDOW = 35
ANCHOR = 8


def _smallest_in(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest gram among each ``width`` consecutive ones."""
    best = np.arange(len(grams))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        have += step
    return best


def _windows(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int):
    """Words of a piece, the word numbers at which a window starts, the anchor
    position of each window and the grams' hashes."""
    starts, ends, first = wh.word_spans(data, offsets)
    words = wh.word_keys(data, starts, ends)
    if len(words) < window:
        none = np.empty(0, np.int64)
        return starts, ends, first, words, none, none, np.empty(0, np.uint64)
    grams = wh.window_hashes(words, anchor, 2)
    owner = _smallest_in(grams, window - anchor + 1)
    row_end = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(owner)) + window <= row_end[:len(owner)])
    return starts, ends, first, words, at, owner[at], grams


def _window_hashes(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return wh.window_hashes(words, window, 3)[at], wh.window_hashes(words, window, 4)[at]


def _text_pieces(table: pa.Table):
    data, offsets = byte_buffer(table["__text"])
    for lo, hi in pieces(offsets):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _counted(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys and how often each occurs."""
    if len(keys[0]) == 0:
        return list(keys), np.empty(0, np.int64)
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(np.append(at, len(order)))


def _block_table(block: int, keys: list[np.ndarray], counts: np.ndarray, names: Sequence[str]) -> pa.Table:
    cols = {n: _signed(k) for n, k in zip(names, keys)}
    # 1 or 2: a window that occurs twice in its block is repeated already
    return pa.table({**cols, "__block": np.full(len(counts), block, np.int32),
                     "n": np.minimum(counts, 2).astype(np.int32)})


def _find_anchors(window: int, anchor: int):
    def find(key, table):
        found = []
        for _, _, data, offsets in _text_pieces(table):
            *_, owner, grams = _windows(data, offsets, window, anchor)
            found.append(grams[owner[np.diff(owner, prepend=-1) != 0]])
        keys, counts = _counted(np.concatenate(found) if found else np.empty(0, np.uint64))
        return _block_table(key[0].as_py(), keys, counts, ["anchor"])
    return find


def _extend(window: int, anchor: int):
    def extend(key, table, seeds):
        repeated = np.sort(np.asarray(seeds["anchor"]).astype(np.int64).view(np.uint64))
        one, two = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        if len(repeated):
            for _, _, data, offsets in _text_pieces(table):
                _, _, _, words, at, owner, grams = _windows(data, offsets, window, anchor)
                if not len(at):
                    continue
                chosen = np.unique(owner)
                hot = np.zeros(len(grams), bool)
                hot[chosen[wh.members(grams[chosen], repeated)]] = True
                at = at[hot[owner]]
                a, b = _window_hashes(words, at, window)
                one.append(a)
                two.append(b)
        keys, counts = _counted(np.concatenate(one), np.concatenate(two))
        return _block_table(key[0].as_py() if key else 0, keys, counts, ["one", "two"])
    return extend


def _remove(window: int, carry: Sequence[str], out_type: pa.Schema):
    def remove(key, table, matched):
        repeated = np.sort(np.asarray(matched["one"]).astype(np.int64).view(np.uint64))
        n_words, n_removed, sizes, texts, spans, span_at = [], [], [], [], [], []
        for _, _, data, offsets in _text_pieces(table):
            starts, ends, first = wh.word_spans(data, offsets)
            n = len(starts)
            gone = np.zeros(n, bool)
            if n >= window and len(repeated):
                words = wh.word_keys(data, starts, ends)
                row_end = np.repeat(first[1:], np.diff(first))[:n - window + 1]
                at = np.flatnonzero(np.arange(n - window + 1) + window <= row_end)
                one = wh.window_hashes(words, window, 3)[at]
                at = at[wh.members(one, repeated)]
                step = np.zeros(n + 1, np.int32)
                step[at] += 1
                step[at + window] -= 1  # window starts are distinct, so are their ends
                gone = np.cumsum(step[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            n_words.append(np.diff(first))
            n_removed.append(total[first[1:]] - total[first[:-1]])
            # maximal repeats: runs of covered words inside a row
            row = wh.rows_of(first)
            run = gone.copy()
            run[1:] &= ~(gone[:-1] & (row[1:] == row[:-1]))
            run_end = gone.copy()
            run_end[:-1] &= ~(gone[1:] & (row[1:] == row[:-1]))
            lo, hi = np.flatnonzero(run), np.flatnonzero(run_end) + 1
            base = first[row[lo]] if len(lo) else lo
            spans.append(np.stack([lo - base, hi - base], 1).reshape(-1, 2))
            span_at.append(np.bincount(row[lo], minlength=len(first) - 1) if len(lo) else np.zeros(len(first) - 1, int))
            # kept words, joined by one space: the byte before a kept word that
            # isn't its row's first kept word is a separator
            left = np.flatnonzero(~gone)
            follows = np.zeros(len(left), bool)
            follows[1:] = row[left][1:] == row[left][:-1]
            out = data.copy()
            step = np.zeros(len(data) + 1, np.int8)
            step[starts[left]] += 1
            step[ends[left]] -= 1
            keep = np.cumsum(step[:-1], dtype=np.int8) > 0
            out[starts[left][follows] - 1] = 0x20
            keep[starts[left][follows] - 1] = True
            texts.append(out[keep])
            total = np.concatenate([[0], np.cumsum(keep)])
            sizes.append(total[offsets[1:]] - total[offsets[:-1]])

        def joined(parts, kind):
            return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)

        size = joined(sizes, np.int64)
        counts = joined(span_at, np.int32)
        flat = np.concatenate(spans) if spans else np.empty((0, 2), np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        cols = {c: table["__c_" + c] for c in carry}
        cols |= {"n_words": joined(n_words, np.int64), "n_removed": joined(n_removed, np.int64),
                 "kept_text": string_array(joined(texts, np.uint8), np.concatenate([[0], np.cumsum(size)])),
                 "first_words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[:, 0], pa.int64())),
                 "end_words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[:, 1], pa.int64())),
                 "was_null": pa.compute.is_null(table["__text"])}
        return pa.table(cols)
    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   carry: Sequence[str] = (), window: int = WINDOW, anchor: int = ANCHOR,
                   blocks: int | None = None) -> DataFrame:
    """One row per input row: the id, the carried columns, ``n_words``,
    ``n_removed``, ``kept_text`` (kept words joined by one space), and the
    maximal repeats as word ranges [first_words[i], end_words[i])."""
    keep = [id_col, *[c for c in carry if c != id_col]]
    blocks = blocks or blocks_for(docs, text_col)
    text = docs.select(F.col(text_col).alias("__text"), *[F.col(c).alias("__c_" + c) for c in keep],
                       block_of(blocks, id_col, text_col).alias("__block"))

    anchors = text.groupBy("__block").applyInArrow(
        _find_anchors(window, anchor), "anchor long, __block int, n int")
    seeds = _more_than_one(anchors, "anchor").select("__block", "anchor")
    windows = text.groupBy("__block").cogroup(seeds.groupBy("__block")).applyInArrow(
        _extend(window, anchor), "one long, two long, __block int, n int")
    matched = _more_than_one(windows, "one", "two").select("__block", "one")
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep]) + (
        ", n_words long, n_removed long, kept_text string, first_words array<long>,"
        " end_words array<long>, was_null boolean")
    return text.groupBy("__block").cogroup(matched.groupBy("__block")).applyInArrow(
        _remove(window, keep, None), schema)


def _more_than_one(counts: DataFrame, *keys: str) -> DataFrame:
    """Rows of keys that occur more than once in all blocks together. A key's
    group has at most one row per block."""
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.withColumn("__total", total).where("__total > 1")
