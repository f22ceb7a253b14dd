"""Helpers shared by the operators: shared tables, sizing, Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import path_join, shared_dir

# bytes of text that one block (one Python call on one task) holds
BLOCK_BYTES = 24 << 20
# bytes of text handled at once inside a task, so that numpy arrays stay small
PIECE_BYTES = 1 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return path_join(shared_dir(spark), "encore-llm", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage,
    so a lost executor rereads files instead of redoing the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A row of the smaller table with more than this share of all weight is hot; at
# most 1 / share rows can be, which bounds what ``hot_join`` broadcasts.
HOT_SHARE = 1e-4


def hot_join(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, how: str = "left") -> DataFrame:
    """``rows`` with the other columns of ``keyed``, which has one narrow row per key
    (nulls match) and in ``weight`` how many rows a key meets. Pass a written table: it
    is read several times.

    Hot keys are broadcast (at most 1 / HOT_SHARE rows, by arithmetic), so their rows
    stay where they are; the others are joined as Spark sees fit. In that second
    join a row that has met a hot key goes by a number of its own, which meets
    nothing, instead of all its like going to one task."""
    others = [c for c in keyed.columns if c not in on]
    share = keyed.agg(F.sum(weight)).scalar() * F.lit(HOT_SHARE)
    packed = F.struct(*[F.col(c) for c in others])
    keys = [F.col(c).alias(f"__on_{c}") for c in on]
    hot = keyed.where(F.col(weight) > share).select(*keys, packed.alias("__hot"))
    # never 1: a constant would not be a join key
    cold = keyed.where(~(F.col(weight) > share)).select(*keys, F.when(F.col(weight) < 0, 1).otherwise(0).cast("long").alias("__own"),
                                                      packed.alias("__cold"))

    def same(left: DataFrame, right: DataFrame):
        return [left[c].eqNullSafe(right[f"__on_{c}"]) for c in on]

    met = rows.join(F.broadcast(hot), same(rows, hot), "left").select(*[rows[c] for c in rows.columns], "__hot")
    own = F.when(F.col("__hot").isNotNull(), F.shiftright(F.xxhash64(*rows.columns), 1).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    met = met.withColumn("__own", own.cast("long"))
    both = met.join(cold, [*same(met, cold), met["__own"] == cold["__own"]], "left").select(
        *[met[c] for c in rows.columns], F.coalesce("__hot", "__cold").alias("__met"))
    both = both.where("__met is not null") if how == "inner" else both
    return both.select(*rows.columns, *[F.col("__met")[c].alias(c) for c in others])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, tasks: int, *cols: str) -> DataFrame:
    """``df`` dealt by the columns to ``tasks`` partitions, where these are more than
    a shuffle of the session has; else Spark's own shuffle of the next step does it."""
    return df.repartition(tasks, *cols) if tasks > shuffle_partitions(df.sparkSession) else df


def blocks_for(df: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks hold the text column at ``block_bytes`` each: measured
    over all rows, and never fewer than the session's shuffle partitions."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(shuffle_partitions(df.sparkSession), -(-total // block_bytes))


def block_of(blocks: int, *cols: str):
    """Block number by the hash of the given columns and the row's place in the input;
    rows of one source, copies of one text, and repeats of one row, in one file
    or many, spread over all blocks. A recomputed partition deals its rows alike."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols], F.monotonically_increasing_id()), F.lit(blocks)).cast("int")


def byte_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the rows' offsets in them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column from UTF-8 bytes and offsets."""
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.string())


def long_lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about ``size`` bytes (one row may be longer)."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last
