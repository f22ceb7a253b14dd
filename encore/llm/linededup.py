"""Line dedup: lines that many documents hold stay in one of them only.

A line's key is the line without the white space at its ends, A-Z lower-cased.
A key of at least ``min_chars`` code points that is found in at least
``min_documents`` documents (ids) loses its lines everywhere but in the document
with the largest id. All steps are built-in functions of Spark.

1. Every eligible line becomes a narrow row: 128 bits of its key's hash, the
   document's id, 128 bits of the hash of id and text, its position. The rows are
   written once; no later step reads a line's text to compare it.
2. One row per key and document (its first position; copies collapse before
   they are shuffled). These rows are partitioned by ranges of (key, part of the
   id) and sorted within by document, largest first, and position. Streaming
   over them, the first row of a run is the first occurrence, the keeper; the
   run's length counts the documents. A key with many documents is a run per
   part of the id, which the ranges deal to several tasks.
3. The runs of a key are added up; repeated keys and their keepers are written.
4. The lines meet the repeated keys. Keys with a large share of all lines (a
   bounded number by arithmetic) are broadcast, the others joined by Spark's
   choice (see ``common.hot_join``).
5. A document with dropped lines gets a keep bitmap, compressed to its runs of
   kept lines. ``keep_bitmaps`` returns these; ``apply_bitmaps`` brings them to
   the texts.

Two lines are equal if 128 bits of their hashes are.

Cases: a null or empty text is one empty line; repeated rows count as one
document, and so do different texts of one id; a null id is the smallest id, and
one document; a line that is repeated within its keeper stays each time; lines
under ``min_chars`` stay; other columns aren't read unless named in ``carry``; an
empty table gives an empty result. Rows equal in id and text meet one bitmap:
should they be very many, Spark's skew join must split them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import dealt, hot_join, shuffle_partitions, written

# The white space that is stripped.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 20
MIN_DOCUMENTS = 3
# rows of (key, document) that a range holds, and parts of the ids under one key
RANGE_ROWS = 2_000_000
ID_PARTS = 1 << 16
# bytes of text that a task of the last join reads
JOIN_BYTES = 256 << 20

_KEY, _ROW = ["__k1", "__k2"], ["__t1", "__t2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    # lower() changes A-Z alone in a line of ASCII
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(*cols: Column) -> tuple[Column, Column]:
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def _identified(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    text = F.col(text_col).cast("string")
    t1, t2 = _hashes(F.col(id_col).isNull(), F.col(id_col), F.coalesce(text, F.lit("")))
    return docs.select(F.col(id_col).alias("__id"), t1.alias("__t1"), t2.alias("__t2"), text.alias("__text"),
                       *[F.col(c).alias(f"__c_{c}") for c in carry])


def eligible_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Step 1: (key hashes, id, row hashes, position) of lines that may be dropped."""
    lines = _identified(docs, id_col, text_col).select("__id", *_ROW, F.posexplode(lines_of(F.col("__text"))).alias("__at", "__line"))
    keyed = lines.select("__id", *_ROW, "__at", key_of(F.col("__line")).alias("__key")).where(F.char_length("__key") >= min_chars)
    k1, k2 = _hashes(F.col("__key"))
    return keyed.select(k1.alias("__k1"), k2.alias("__k2"), "__id", *_ROW, "__at")


def repeated_keys(lines: DataFrame, min_documents: int) -> DataFrame:
    """Steps 2 and 3: key, ``__keeper`` (the largest id that holds it), ``__holders``."""
    n = max(shuffle_partitions(lines.sparkSession), -(-lines.count() // RANGE_ROWS))
    holders = lines.groupBy(*_KEY, "__id").agg(F.min("__at").alias("__at"))
    part = F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(ID_PARTS)).cast("int")
    order = [F.desc_nulls_last("__id"), F.asc("__at")]
    ranged = holders.withColumn("__part", part).repartitionByRange(n, *_KEY, "__part")
    run = Window.partitionBy(*_KEY, "__part").orderBy(*order)
    streamed = ranged.select(*_KEY, "__id", F.row_number().over(run).alias("__n"))
    first = F.when(F.col("__n") == 1, F.struct(F.col("__id").isNotNull().alias("known"), F.col("__id").alias("id")))
    return (streamed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("__holders"), F.max(first).alias("__first"))
            .where(F.col("__holders") >= min_documents)
            .select(*_KEY, F.col("__first.id").alias("__keeper"), "__holders"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """A row per document (hash of id and text) with dropped lines: ``__t1``,
    ``__t2``, ``n_dropped``, ``kept_runs`` (position, number of lines), the last run
    open-ended (number null)."""
    lines = written(eligible_lines(docs, id_col, text_col, min_chars), "lines")
    repeated = written(repeated_keys(lines, min_documents), "repeated-lines")
    met = hot_join(lines, repeated, _KEY, "__holders", how="inner")
    dropped = met.where(~F.col("__id").eqNullSafe(F.col("__keeper")))
    gone = dropped.groupBy(*_ROW).agg(F.array_sort(F.collect_set("__at")).alias("__gone"))
    # between two dropped lines lies a run of kept ones, perhaps of none
    starts = F.concat(F.array(F.lit(0)), F.transform("__gone", lambda at: at + 1))
    runs = F.zip_with(starts, "__gone", lambda start, end: F.struct(start.alias("first"), (end - start).alias("lines")))
    return gone.select(*_ROW, F.size("__gone").cast("long").alias("n_dropped"),
                       F.filter(runs, lambda r: r["lines"].isNull() | (r["lines"] > 0)).alias("kept_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: the id, carried columns, n_lines, n_dropped, kept_text."""
    carried = [c for c in carry if c != id_col]
    rows = _identified(docs, id_col, text_col, carried)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    tasks = -(-size // JOIN_BYTES)
    found = bitmaps.select(*_ROW, F.col("n_dropped").alias("__dropped"), F.col("kept_runs").alias("__runs"))
    met = dealt(rows, tasks, *_ROW).join(dealt(found, tasks, *_ROW), _ROW, "left").select(
        F.col("__id").alias(id_col), *[F.col(f"__c_{c}").alias(c) for c in carried], "__text", "__dropped", "__runs")
    lines = met.withColumn("__lines", lines_of(F.col("__text")))
    all_of = F.size("__lines")
    kept = F.flatten(F.transform("__runs", lambda r: F.slice("__lines", r["first"] + 1, F.coalesce(r["lines"], all_of))))
    text = F.when(F.col("__dropped").isNull(), F.coalesce("__text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    return lines.select(id_col, *carried, all_of.cast("long").alias("n_lines"),
                        F.coalesce("__dropped", F.lit(0).cast("long")).alias("n_dropped"), text.alias("kept_text"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, carry: Sequence[str] = (),
                        min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents without repeated lines: bitmaps made, written and applied."""
    bitmaps = written(keep_bitmaps(docs, id_col, text_col, min_chars=min_chars, min_documents=min_documents), "keep-bitmaps")
    return apply_bitmaps(docs, bitmaps, id_col, text_col, carry=carry)
