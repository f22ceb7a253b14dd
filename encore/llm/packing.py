"""Best-fit packing of documents' tokens into sequences of a fixed length.

A document is its token ids and an end id. Only documents longer than a
sequence are cut: the first piece takes the rest of the division, the others
fill a sequence each. The short pieces are packed by bounded-space online
best fit: a fixed number of open bins, kept in a bitset keyed by their free
space; a piece goes to the open bin that it leaves fullest, else opens a bin,
and when too many are open the fullest closes first.

Scale: cutting is one pass over the texts without a shuffle. Only one narrow
row per piece (no ids) is written and dealt by hash to groups of about
``GROUP_ROWS`` pieces. Each group is packed by itself, online: its pieces are
taken once, in the order in which they were written, and only the open bins are
looked at. A third of all rows in one source, copies of one text, or repeats of
one row are dealt like any other rows.

Cases: null text is an empty document (its end id alone); repeated rows are
packed each; null ids are kept; of open bins with equal free space the one
used last is taken; other columns are not read; an empty table packs into no sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import byte_buffer, dealt, written
from encore.llm.encoding import Encoder

SEQUENCE = 2048
OPEN_BINS = 2048
GROUP_ROWS = 16_000


def cut(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
        sequence: int = SEQUENCE, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces_of(batches):
        encoder = Encoder.at(tokenizer)
        for batch in batches:
            data, offsets = byte_buffer(batch.column(1))
            ids, at = encoder.encode(data, offsets)
            row, piece, start, length, crc, each = [], [], [], [], [], []
            tail = np.array([end_id], "<u4")
            for r in range(batch.num_rows):
                mine = np.concatenate([ids[at[r]:at[r + 1]].astype("<u4", copy=False), tail])
                lo, n = 0, 0
                hi = (len(mine) - 1) % sequence + 1
                while lo < len(mine):
                    row.append(r)
                    piece.append(n)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(mine[lo:hi].tobytes()))
                    if with_ids:
                        each.append(mine[lo:hi].astype(np.int32))
                    lo, hi, n = hi, hi + sequence, n + 1
            out = {id_col: batch.column(0).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()),
                   "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                   "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                out["ids"] = pa.array(each, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(pieces_of, schema)


def best_fit(lengths: list[int], sequence: int = SEQUENCE, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """Bin and place of each piece, taken in the given order."""
    free_bits = 0  # bit f is set while an open bin has f places free
    by_free: list[list[int]] = [[] for _ in range(sequence + 1)]
    free, n_open, bins, places = [], 0, [], []
    for length in lengths:
        fits = free_bits >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            b = by_free[f].pop()
            if not by_free[f]:
                free_bits &= ~(1 << f)
        else:
            if n_open == open_bins:  # the fullest closes
                f = (free_bits & -free_bits).bit_length() - 1
                by_free[f].pop()
                if not by_free[f]:
                    free_bits &= ~(1 << f)
                n_open -= 1
            b = len(free)
            free.append(sequence)
            n_open += 1
        bins.append(b)
        places.append(sequence - free[b])
        free[b] -= length
        if free[b]:
            by_free[free[b]].append(b)
            free_bits |= 1 << free[b]
        else:
            n_open -= 1  # full
    return bins, places


def pack(cut_pieces: DataFrame, id_col: str = "doc_id", *, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. Pass a written table: it
    is read twice."""
    groups = max(1, -(-cut_pieces.count() // group_rows))
    names = cut_pieces.columns

    def packed(key, table):
        table = table.sort_by("__place").select(names)
        bins, places = best_fit(table["length"].to_pylist(), sequence, open_bins)
        table = table.append_column("sequence_id", pa.array(np.asarray(bins, np.int64) * groups + key[0].as_py(), pa.int64()))
        return table.append_column("offset", pa.array(places, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema)
    # the row's place in the written files: the order of arrival, and what parts equal rows
    placed = cut_pieces.withColumn("__place", F.monotonically_increasing_id())
    group = F.pmod(F.xxhash64(id_col, "piece", "start", "ids_crc32", "__place"), F.lit(groups))
    return (dealt(placed.withColumn("__group", group), groups, "__group").groupBy("__group").applyInArrow(packed, fields + ", sequence_id long, `offset` long"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
                   sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS,
                   end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Cut and pack whole documents."""
    cuts = written(cut(docs, tokenizer, id_col, text_col, sequence=sequence, end_id=end_id, with_ids=with_ids), "pieces")
    return pack(cuts, id_col, sequence=sequence, open_bins=open_bins, group_rows=group_rows)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences' ids in order, from pieces packed ``with_ids``. A
    sequence holds at most its own length in tokens, so groups are bounded."""
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"),
                    F.col("parts.offset").alias("part_offsets")))
