"""Fill-in-middle transformation: a text's prefix, middle and suffix change places.

A text is cut into units (lines with their line break, the last one perhaps
without). Two numbers drawn from the SHA-256 of seed and id choose after which
units the prefix and the middle end; further numbers choose whether the text is
changed at all and the order of its parts (psm: prefix, suffix, middle; spm:
suffix, prefix, middle), each part after its mark.

Texts are measured chunk by chunk. A rolling hash over the last 32 bytes ends a
chunk where its low bits are zero, so equal passages fall into equal chunks
wherever they stand. A worker keeps a summary of each distinct chunk under the
chunk's own bytes (a hit compares the bytes, not only their hash): code points,
the places of its line breaks, whether it holds a mark. Marks that cross two
chunks are looked for in the few bytes around the seam. Adding up the chunks'
counts gives the number of units and finds the chunk that holds a cut; its
summary gives the place in it.

Scale: one pass without a shuffle; a row of output per row of input. The kept
summaries are bounded by ``KEPT_BYTES`` a worker and start anew beyond it, which
changes no result; output leaves a task in batches of about ``OUT_BYTES``.

Cases: null text is an empty text; an empty text, or one that holds a mark, stays
as it is (``plain``); a null id draws from the seed alone; repeated rows come out
alike; one unit gives cuts at its start or end; other columns aren't read unless
named in ``carry``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import byte_buffer, pieces

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7
CHUNK_BITS = 9          # a chunk ends at one of 512 places on average
CHUNK_MOST = 1 << 14    # and is cut after so many bytes where no place is found
ROLL = 32               # bytes that the rolling hash looks back on
KEPT_BYTES = 64 << 20
OUT_BYTES = 8 << 20

_VALUE = np.random.default_rng(61).integers(0, 2**32, 256, dtype=np.uint32)
_GOES_ON = np.zeros(256, np.uint8)  # bytes inside a code point
_GOES_ON[0x80:0xC0] = 1


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of a buffer of texts, the texts' ends among them.

    The hash is a sum of shifted byte values over the last ``ROLL`` bytes, made
    by doubling the bytes looked back on. The first bytes of a text end no
    chunk, as their hash would look back into the text before."""
    rolling = _VALUE[data]
    width = 1
    while width < min(ROLL, len(data)):
        before = rolling.copy()
        rolling[width:] += before[:-width] << np.uint32(width)
        width *= 2
    ends = np.flatnonzero(rolling & np.uint32((1 << CHUNK_BITS) - 1) == 0) + 1
    row = np.searchsorted(offsets, ends - 1, "right") - 1
    ends = ends[ends - offsets[row] >= ROLL]
    ends = np.union1d(ends, offsets[1:])
    starts = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - starts > CHUNK_MOST)
    if len(long):
        ends = np.union1d(ends, np.concatenate(
            [np.arange(starts[i] + CHUNK_MOST, ends[i], CHUNK_MOST) for i in long]))
    return ends[ends > 0]


class Summaries:
    """Summaries of distinct chunks, kept under their bytes."""

    def __init__(self, most: int = KEPT_BYTES):
        self.most, self.bytes, self.hits = most, 0, 0
        self.kept: dict[bytes, tuple[int, list[int], bool]] = {}

    def of(self, chunk: bytes) -> tuple[int, list[int], bool]:
        """Code points, ends of the units that end in the chunk, holds a mark."""
        found = self.kept.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        raw = np.frombuffer(chunk, np.uint8)
        found = (len(chunk) - int(_GOES_ON[raw].sum()), (np.flatnonzero(raw == 10) + 1).tolist(),
                 any(m in chunk for m in MARKS))
        if self.bytes > self.most:
            self.kept, self.bytes = {}, 0
        self.kept[chunk] = found
        self.bytes += len(chunk) + 8 * len(found[1]) + 200
        return found


def _measured(raw: bytes, ends: Sequence[int], start: int, summaries: Summaries):
    """A text's chunks combined: per chunk its start, units before it and code
    points before it; its summaries; units that end in a line break; whether a
    mark is in the text."""
    at, units, points, parts, marked, seam = [], [], [], [], False, b""
    n_units = n_points = 0
    for end in ends:
        chunk = raw[start:end]
        part = summaries.of(chunk)
        at.append(start)
        units.append(n_units)
        points.append(n_points)
        parts.append(part)
        marked = marked or part[2] or any(m in seam + chunk[:2] for m in MARKS)
        seam = (seam + chunk)[-2:] if len(chunk) < 2 else chunk[-2:]
        n_points += part[0]
        n_units += len(part[1])
        start = end
    return at, units, points, parts, n_units, marked


def _place(unit: int, raw: bytes, measured) -> tuple[int, int]:
    """Byte and code point after the unit-th line break (unit > 0)."""
    at, units, points, parts = measured[:4]
    i = bisect_left(units, unit) - 1
    inside = parts[i][1][unit - units[i] - 1]
    head = np.frombuffer(raw, np.uint8, inside, at[i])
    return at[i] + inside, points[i] + inside - int(_GOES_ON[head].sum())


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four numbers from the digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, carry: Sequence[str] = (),
              seed: int = SEED, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """One row per input row: the id, carried columns, n (units), form, prefix_chars,
    middle_chars (code points; null if plain), output."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    carried = [c for c in carry if c != id_col]

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for batch in batches:
            data, offsets = byte_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            rows, size, first = [], 0, 0
            for lo, hi in pieces(offsets):
                piece = data[offsets[lo]:offsets[hi]]
                raw, own = piece.tobytes(), offsets[lo:hi + 1] - offsets[lo]
                ends = chunk_ends(piece, own)
                cut = np.searchsorted(ends, own[1:], "right")
                before = 0
                for r in range(lo, hi):
                    upto = int(cut[r - lo])
                    start, end = int(own[r - lo]), int(own[r - lo + 1])
                    mine = ends[before:upto].tolist() if end > start else []
                    before = upto
                    rows.append(_row(ids[r], raw, start, end, mine, summaries, seed, rate, spm_rate))
                    size += end - start
                if size >= OUT_BYTES or hi == batch.num_rows:
                    yield _out(batch, first, hi, rows, names, id_col, carried)
                    rows, size, first = [], 0, hi

    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    schema = ", ".join(f"`{c}` {fields[c]}" for c in [id_col, *carried])
    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"),
                       *[F.col(c).alias(f"__c_{c}") for c in carried]).mapInArrow(
        changed, schema + ", n long, form string, prefix_chars long, middle_chars long, output string")


def _row(doc_id, raw: bytes, start: int, end: int, ends: list[int], summaries: Summaries, seed, rate, spm_rate):
    measured = _measured(raw, ends, start, summaries)
    breaks, marked = measured[4], measured[5]
    n = breaks + (end > start and raw[end - 1] != 10)
    h = draws(doc_id, seed)
    if end == start or marked or h[2] % 100 >= rate:
        return n, "plain", None, None, raw[start:end]
    whole = measured[2][-1] + measured[3][-1][0]
    places = []
    for unit in sorted((h[0] % (n + 1), h[1] % (n + 1))):
        places.append((start, 0) if unit == 0 else (end, whole) if unit == n else _place(unit, raw, measured))
    (a, a_points), (b, b_points) = places
    head, middle, tail = PREFIX + raw[start:a], MIDDLE + raw[a:b], SUFFIX + raw[b:end]
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    parts = (tail, head, middle) if form == "spm" else (head, tail, middle)
    return n, form, a_points, b_points - a_points, b"".join(parts)


def _out(batch: pa.RecordBatch, lo: int, hi: int, rows, names, id_col, carried) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    made[4] = made[4].cast(pa.string())
    left = [batch.column(0), *[batch.column(2 + i) for i in range(len(carried))]]
    return pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in left], *made], [id_col, *carried, *names])


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form. A changed text holds no mark, so each
    mark's first place is its own."""
    marks = {"p": PREFIX.decode(), "s": SUFFIX.decode(), "m": MIDDLE.decode()}

    def parts(order: str) -> dict[str, Column]:
        rest, out = F.substring(output, 4, 2**31 - 1), {}
        for this, following in zip(order, order[1:]):
            out[this] = F.substring_index(rest, marks[following], 1)
            rest = F.substring(rest, F.length(out[this]) + 4, F.lit(2**31 - 1))
        return out | {order[-1]: rest}

    psm, spm = parts("psm"), parts("spm")
    joined = lambda x: F.concat(x["p"], x["m"], x["s"])
    return F.when(form == "psm", joined(psm)).when(form == "spm", joined(spm)).otherwise(output)
