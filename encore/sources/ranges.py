"""Large JSON arrays of objects read by several tasks a file.

Spark's text reader cuts a file into byte ranges at ``}`` (its line separator here),
so a fragment is the text up to the next closing brace, wherever that stands: at a
record's end, inside a nested object, or inside a string. Whether a fragment
starts inside a string, and how deep, is a prefix scan over all fragments before it:

* a backslash escapes within strings only, so with escapes taken out the number of
  quotes says, for either start, how the state at the end differs from it;
* braces count where the text is outside of strings, which is known for either start.

Most files need no scan: where every fragment has an even number of quotes and
opens one brace, each is a record by induction. One narrow pass finds these
files; their fragments are parsed where they are read. In the others a range's
fragments are added up for both possible starts, ranges are chained per file
(a row per range), and each fragment then knows its state; fragments up to the next
start at depth 0 are one record, even across ranges.

A file whose frame isn't ``[ record, record ... ]``, or that ends within a record,
fails, and so does a record that is no JSON.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AT = ["file", "block", "seq"]
_HEAD, _NEXT = r"^\s*\[\s*\{", r"^\s*,\s*\{"
_TAIL, _NONE = r"^\s*\]\s*$", r"^\s*\[\s*\]\s*$"


def _fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "}").text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text")))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _marks(fragments: DataFrame) -> DataFrame:
    """``odd``: the number of quotes is; ``opens0``, ``opens1``: braces opened outside
    of strings if the fragment starts outside, inside a string."""
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    outside = lambda t: F.regexp_replace(t, r'"[^"]*("|$)', "")
    first = F.instr(F.col("_bare"), '"')
    rest = F.when(first > 0, F.substring("_bare", first + 1, F.length("_bare"))).otherwise(F.lit(""))
    return (fragments.withColumn("_bare", bare)
            .select(*_AT, "text", (_count(F.col("_bare"), '"') % 2).alias("odd"),
                    _count(outside(F.col("_bare")), "{").alias("opens0"), _count(outside(rest), "{").alias("opens1")))


def _frames(marks: DataFrame) -> list:
    """Per file: whether it is empty, has plain records only, and is framed as an array."""
    text, at = F.col("text"), [F.col("block"), F.col("seq")]
    tail = text.rlike(_TAIL)
    none = text.rlike(_NONE)
    return marks.groupBy("file").agg(
        F.max("odd").alias("odd"), F.count_if(~tail & ~none & (F.col("opens0") != 1)).alias("nested"), F.count_if(tail).alias("tails"),
        F.count_if(~tail & ~none & ~text.rlike(_NEXT)).alias("not_next"), F.count(F.lit(1)).alias("n"), F.count_if(none).alias("none"),
        F.min(F.struct(*at, text.rlike(_HEAD).alias("is"))).getField("is").alias("head"),
        F.max(F.struct(*at, tail.alias("is"))).getField("is").alias("tail")).collect()


def _records_across(marks: DataFrame) -> DataFrame:
    """Records (file, text) of files whose records may hold several fragments."""
    own = Window.partitionBy("file", "block").orderBy("seq")
    prior, upto = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    files = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda what, w: F.coalesce(F.sum(what).over(w), F.lit(0))
    # the closing brace counts where the fragment ends outside of a string
    ends0, ends1 = F.col("opens0") - (1 - F.col("odd")), F.col("opens1") - F.col("odd")
    a = marks.withColumns({"flips": before("odd", prior) % 2, "deeper0": ends0, "deeper1": ends1})
    same = F.col("flips") == 0
    a = a.withColumns({"x0": F.when(same, F.col("deeper0")).otherwise(F.col("deeper1")),
                       "x1": F.when(same, F.col("deeper1")).otherwise(F.col("deeper0"))})
    a = a.withColumns({"s0": before("x0", prior), "s1": before("x1", prior)})
    ranges = a.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"), F.sum("x0").alias("x0"), F.sum("x1").alias("x1"))
    ranges = ranges.withColumn("inside", before("odd", files) % 2)
    ranges = ranges.withColumn("depth", before(F.when(F.col("inside") == 0, F.col("x0")).otherwise(F.col("x1")), files))
    b = a.join(ranges.select("file", "block", "inside", "depth"), ["file", "block"])
    depth = F.col("depth") + F.when(F.col("inside") == 0, F.col("s0")).otherwise(F.col("s1"))
    starts = (depth == 0) & ((F.col("inside") + F.col("flips")) % 2 == 0)
    b = b.withColumn("start", F.when(starts, F.struct("block", "seq")))
    carried = (b.groupBy("file", "block").agg(F.max("start").alias("last"))
               .select("file", "block", F.last("last", ignorenulls=True).over(files).alias("carried")))
    c = b.withColumn("start", F.last("start", ignorenulls=True).over(upto)).join(carried, ["file", "block"])
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "text")))
    return (c.groupBy("file", F.coalesce("start", "carried").alias("start")).agg(parts.alias("parts"))
            .select("file", F.col("start.block").alias("block"), F.col("start.seq").alias("seq"),
                    F.array_join("parts.text", "}").alias("text")))


def _broken(file: Column) -> Column:
    return F.raise_error(F.concat(F.lit("malformed: not a whole JSON array of records: "), file)).cast("string")


def _checked(records: DataFrame) -> DataFrame:
    """Records of a scan without their file's frame, which must be whole."""
    text, at = F.col("text"), F.struct("block", "seq")
    # a row per file
    ends = records.groupBy("file").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    is_first, is_last = F.col("first") == at, F.col("last") == at
    ok = F.when(is_last, text.rlike(_TAIL) & ~is_first).when(is_first, text.rlike(_HEAD)).otherwise(text.rlike(_NEXT))
    checked = F.when(ok, text).otherwise(_broken(F.col("file")))
    return (records.join(F.broadcast(ends), "file").select(checked.alias("text"), is_last.alias("_tail"))
            .where(F.col("text").isNotNull() & ~F.col("_tail")).select("text"))


def read_records(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The objects of JSON arrays, by ``schema``."""
    frames = _frames(_marks(_fragments(spark, paths)))
    given = {unquote(urlparse(p).path): p for p in paths}  # Spark names files by escaped URIs
    plain, across = [], []
    for f in frames:
        if f.none == 1 and f.n == 1:
            continue
        whole = f.nested == 0 and f.odd == 0
        if whole and not (f.head and f.tail and f.tails == 1 and f.not_next == 1):
            raise ValueError(f"malformed: not a whole JSON array of records: {f.file}")
        (plain if whole else across).append(given[unquote(urlparse(f.file).path)])
    if len(frames) < len(given):
        raise ValueError(f"malformed: an empty file among {sorted(given)}")
    texts = []
    if plain:
        texts.append(_fragments(spark, plain).where(~F.col("text").rlike(_TAIL)).select("text"))
    if across:
        texts.append(_checked(_records_across(_marks(_fragments(spark, across)))))
    if not texts:
        return spark.createDataFrame([], schema)
    text = texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])
    record = F.concat(F.regexp_replace("text", r"^\s*[\[,]\s*", ""), F.lit("}"))
    return text.select(F.from_json(record, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
