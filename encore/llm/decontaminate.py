"""Benchmark decontamination: test items that a document contains.

Size-partitioned MinHash containment search. Items are partitioned by their
number of distinct shingles into classes [2^j, 2^(j+1)). An item's sketch is
its smallest shingle hashes; the class sets how many: with u the class's upper
bound, floor((1 - threshold) * u) + 1. A document that holds at least the
threshold's share of an item misses at most floor((1 - threshold) * n) of its
n shingles, so it holds one of the sketch for sure: the search over minimum
hashes loses nothing, however long the document. Candidates are then verified
by exact containment on the shingles themselves.

Only DataFrame functions are used. Scale: the sketch is broadcast while its
measured row count stays under ``broadcast_rows``, and joined by a shuffle of
the hashes beyond it; the items that verify are broadcast under a measured
size, and joined by salted keys beyond it; document shingles are made and looked up in one
generated stage, so only hits leave it. Only candidate documents are read
again.

Words are runs of characters other than space and 0x09-0x0D, lower-cased.
Cases: null or short documents hold no shingle; items with fewer words than a
shingle are never found; repeated documents and repeated items give a row
each; null ids are kept; other columns are not read; empty tables give an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import written

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
_BLANKS = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    bare = F.btrim(F.lower(text.cast("string")), F.lit(_BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _shingle_texts(word_list: Column, size: int) -> Column:
    return F.when(F.size(word_list) >= size, F.transform(
        F.sequence(F.lit(1), F.size(word_list) - size + 1),
        lambda i: F.array_join(F.slice(word_list, i, size), " "))).otherwise(F.array().cast("array<string>"))


def _shingle_hash(word_list: str, at: str, size: int) -> Column:
    return F.xxhash64(*[F.expr(f"{word_list}[{at} + {j}]") for j in range(size)])


def sketches(items: DataFrame, item_id: str, text: str, *, shingle: int = SHINGLE,
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per item: ``__ikey``, ``__item``, ``__shingles`` (distinct), ``__size``, ``__sketch``."""
    wide = items.select(F.col(item_id).alias("__item"), words(F.col(text)).alias("__words"))
    wide = wide.select("__item", F.array_distinct(_shingle_texts(F.col("__words"), shingle)).alias("__shingles"))
    wide = wide.withColumn("__size", F.size("__shingles")).where("__size > 0")
    upper = F.pow(F.lit(2.0), F.length(F.bin(F.col("__size").cast("long")))) - 1
    # a tiny slack against the threshold's binary rounding only lengthens the sketch
    length = F.floor(F.lit(1 - threshold + 1e-9) * upper).cast("int") + 1
    hashes = F.array_sort(F.transform("__shingles", lambda s: _text_hash(s, shingle)))
    return wide.withColumn("__sketch", F.slice(hashes, 1, length)).withColumn(
        "__ikey", F.xxhash64("__item", "__shingles"))


def _text_hash(shingle_text: Column, size: int) -> Column:
    parts = F.split(shingle_text, " ")
    return F.xxhash64(*[F.get(parts, F.lit(j)) for j in range(size)])


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", *, shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, broadcast_rows: int = BROADCAST_ROWS,
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row per document and item that it contains: id, item id,
    ``item_shingles``, ``matched`` and ``containment``."""
    items = written(sketches(items, item_id, item_text, shingle=shingle, threshold=threshold), "items")
    index = items.select("__ikey", F.explode("__sketch").alias("__hash")).distinct()
    keyed = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    keyed = keyed.withColumn("__key", F.xxhash64("__id", "__text"))
    at = F.when(F.size("__words") >= shingle, F.sequence(F.lit(0), F.size("__words") - shingle))
    hashed = (keyed.select("__key", words(F.col("__text")).alias("__words"))
              .select("__key", "__words", F.explode(at).alias("__at"))
              .select("__key", _shingle_hash("__words", "__at", shingle).alias("__hash")))
    if index.count() <= broadcast_rows:
        index = F.broadcast(index)
    candidates = written(hashed.join(index, "__hash").select("__key", "__ikey").distinct(), "candidates")
    # candidates are few: joined by their key with the texts, then with the items
    pairs = _with_items(keyed.join(candidates, "__key"), items.select("__ikey", "__item", "__shingles", "__size"),
                        broadcast_bytes)
    # the words are made once per row: a generator keeps the optimizer from copying
    # the split into each use of them
    pairs = pairs.select("__id", "__item", "__shingles", "__size", F.explode(F.array(words(F.col("__text")))).alias("__words"))
    verified = pairs.withColumn("matched", F.size(F.array_intersect(
        F.col("__shingles"), _shingle_texts(F.col("__words"), shingle))))
    # n * threshold is compared in whole numbers of shingles
    need = F.ceil(F.col("__size") * F.lit(threshold) - F.lit(1e-9))
    return verified.where(F.col("matched") >= need).select(
        F.col("__id").alias(id_col), F.col("__item").alias(item_id), F.col("__size").cast("long").alias("item_shingles"),
        F.col("matched").cast("long").alias("matched"), (F.col("matched") / F.col("__size")).alias("containment"))


def _with_items(pairs: DataFrame, items: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Pairs with their item. One item may be in a third of all documents: items
    are broadcast under a measured size, and beyond it each is copied to
    ``SALTS`` keys, over which its documents are dealt."""
    length = F.aggregate("__shingles", F.lit(0).cast("long"), lambda total, s: total + F.octet_length(s) + 16)
    size = items.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        return pairs.join(F.broadcast(items), "__ikey")
    salt = F.pmod(F.xxhash64("__key", F.lit(7)), F.lit(SALTS)).cast("int")
    copies = items.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("__salt", salt).join(copies, ["__ikey", "__salt"]).drop("__salt")


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that contain no test item, unchanged."""
    found = contained_items(docs.select(F.xxhash64(id_col, text_col).alias("__row"), F.col(text_col).alias("__t")), items,
                            "__row", "__t", **options).select("__row").distinct()
    return docs.withColumn("__row", F.xxhash64(id_col, text_col)).join(found, "__row", "left_anti").drop("__row")
