"""A training-corpus pipeline of the library's own operators.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's documents. All but the last return the columns of
``documents``:

1. quality classifier: documents predicted as label 0 go;
2. SimHash near-dedup: the document with the smallest id of each group stays
   (rows that repeat one id: the smallest text by hash; a null id only if its
   group has no other);
3. substring dedup: words covered by repeated windows go; the others are
   joined by one space, and ``n_chars`` is counted anew. A document without
   repeats keeps its text as it is;
4. benchmark decontamination: documents that contain a test item go;
5. best-fit packing: pieces of at most 2048 tokens with their sequences.

Cases: a null or empty text is a document without lines and words (stage 1 scores it
like any other; those that stay form one group in stage 2); very long texts
are read whole in every stage; rows equal in id and text are one document after stage 2;
columns beyond those of ``documents`` are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm import decontaminate, packing, quality, repeats, simhash
from encore.llm.common import written
from encore.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(*COLUMNS), model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are told apart by 128 bits of id and text, so that repeated ids don't keep one another
    row = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit("row"), "text", "doc_id").alias("b"))
    keyed = docs.select(*COLUMNS, row.alias("__row"))
    ordered = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("__row").alias("row"))
    found = simhash.groups(keyed.select(ordered.alias("doc"), "text"), "doc", "text")
    stay = found.where("doc = component_id").select(F.col("doc.row").alias("__row")).distinct()
    kept = keyed.join(stay, "__row", "left_semi")
    # exact copies of one row are left once
    first = Window.partitionBy("__row").orderBy("lang", "source", "n_chars")
    return kept.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(docs, carry=COLUMNS[1:])
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"), "lang", "source",
                        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs.select(*COLUMNS), items)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality classifier", quality_classifier), ("simhash near-dedup", simhash_near_dedup),
          ("substring dedup", substring_dedup), ("benchmark decontamination", benchmark_decontamination),
          ("best-fit packing", best_fit_packing)]

# a trained classifier and a tokenizer are no SQL: tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
