"""Token-id files: flat unsigned integers and 64-bit document offsets.

Each shard holds a range of ids in ascending order: ``N.bin`` (ids, little
endian, 16 bits where the vocabulary fits, else 32), ``N.off`` (64-bit offsets
of its documents, one more at the end), ``N.doc`` (64-bit document ids) and
``N.nul`` (a byte per document, 1 for a null id). A manifest has a row per
shard; each shard's base, the ids before it, is a prefix sum over the
manifest. Readers map the files into memory.

Scale: one range shuffle of the texts by id, hash and place in the input, so
rows equal in all columns part too; then each task encodes its range
and writes one shard. Files get a name of their own first and are renamed, so
a task that runs again replaces its shard by equal files. The folder may be
any that pyarrow opens by URI (local, HDFS, S3, GCS).

Cases: null text is an empty document (end id alone); null ids come first;
repeated ids are ordered by the text's hash; equal rows are interchangeable; other columns are not read; an empty table
gives no shard and an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.common import blocks_for, byte_buffer, scratch_path
from encore.session import path_join
from encore.llm.encoding import Encoder

_SUFFIXES = ("bin", "off", "doc", "nul")


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def _mapped(files: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's numbers: mapped into memory where the folder is local."""
    if files.get_file_info(path).size == 0:
        return np.empty(0, kind)
    source = pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path)
    return np.frombuffer(source.read_buffer(), kind)


def write_files(docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
                end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Write all documents' ids; returns the manifest (shard, n_docs, n_tokens,
    width, base)."""
    spark = docs.sparkSession
    shards = shards or blocks_for(docs, text_col)

    def shard_of(batches):
        files, folder = _open(root)
        encoder = Encoder.at(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        context = TaskContext.get()
        shard = context.partitionId()
        names = [f"{folder}/{shard:08d}.{s}" for s in _SUFFIXES]
        out, n_docs, n_tokens = None, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                files.create_dir(folder, recursive=True)
                out = [files.open_output_stream(f"{x}.{context.taskAttemptId()}") for x in names]
                out[1].write(np.zeros(1, "<u8").tobytes())
            data, offsets = byte_buffer(batch.column(1))
            ids, at = encoder.encode(data, offsets)
            ids = np.insert(ids, at[1:], end_id)
            ends = at[1:] + np.arange(1, len(at))
            key = batch.column(0)
            out[0].write(ids.astype(f"<u{width}").tobytes())
            out[1].write((n_tokens + ends).astype("<u8").tobytes())
            out[2].write(np.asarray(key.fill_null(0)).astype("<i8").tobytes())
            out[3].write(np.asarray(key.is_null(), dtype=bool).astype(np.uint8).tobytes())
            n_docs, n_tokens = n_docs + batch.num_rows, n_tokens + len(ids)
        if out is not None:
            for stream, x in zip(out, names):
                stream.close()
                files.move(f"{x}.{context.taskAttemptId()}", x)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([n_tokens], pa.int64()), "width": pa.array([width], pa.int32())})

    # ranges are sampled on narrow keys: the text only orders rows of equal id and hash inside a
    # shard, and the place parts rows that are equal in both
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = (rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
            .repartitionByRange(shards, "id", "tie", "place")
            .sortWithinPartitions("id", "tie", "text").select("id", "text").mapInArrow(shard_of, "shard int, n_docs long, n_tokens long, width int"))
    manifest = path_join(root, "manifest")
    made.write.parquet(manifest)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(made.schema).parquet(manifest)
            .withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))))


def read_files(spark: SparkSession, root: str, manifest: DataFrame, id_col: str = "doc_id",
               shards: int | None = None) -> DataFrame:
    """Per document, read back from the files: id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as 32-bit numbers)."""
    def docs_of(batches):
        files, folder = _open(root)
        for batch in batches:
            for row in batch.to_pylist():
                stem = f"{folder}/{row['shard']:08d}"
                ids, off, doc, nul = (_mapped(files, f"{stem}.{s}", k) for s, k in
                                      zip(_SUFFIXES, (f"<u{row['width']}", "<u8", "<i8", "u1")))
                off = off.astype(np.int64)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_pydict({
                    id_col: pa.array(doc, pa.int64(), mask=nul.astype(bool)),
                    "start": pa.array(row["base"] + off[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(off), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return (manifest.select("shard", "width", "base").repartition(shards or 200, "shard")
            .mapInArrow(docs_of, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
               end_id: int = 0, root: str | None = None) -> DataFrame:
    """Write the files and read every document back."""
    root = root or scratch_path(docs.sparkSession, "tokens")
    shards = blocks_for(docs, text_col)
    manifest = write_files(docs, root, tokenizer, id_col, text_col, end_id=end_id, shards=shards)
    return read_files(docs.sparkSession, root, manifest, id_col, shards)
