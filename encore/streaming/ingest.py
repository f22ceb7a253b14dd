"""Incremental ingest (optional extension X1): newly landed export files are
cleaned as they arrive, with the batch clean's column rules.

* source: ``readStream`` JSON over the landing folder (schema'd, multiLine; a
  broken file fails the stream)
* exact duplicates: each micro-batch is deduplicated and anti-joined with the
  plays already written for its days. No watermark is involved, so an old
  export file that lands late is taken whole
* sinks: the clean rows of batch N in ``streaming_clean/batch=N``, by day, and daily
  plays and skips per country, rewritten for the days a batch touched. A batch reads
  those days' folders only, however many batches there were

Both writes are repeatable: a micro-batch that runs again replaces its own
folder and its days. Progress lies in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from encore.operators.clean import BASE_COLUMNS, MIN_MS_PLAYED, typed_rows, with_derived
from encore.session import path_join
from encore.sources.raw import EXPORT_GLOB, RAW_SCHEMA


def landed_plays(spark: SparkSession, landing_dir: str, pattern: str = EXPORT_GLOB,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(RAW_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


def daily_activity(clean: DataFrame) -> DataFrame:
    """Per (UTC day, country) activity."""
    return (clean.groupBy("date", "country")
                 .agg(F.count(F.lit(1)).alias("plays"),
                      F.sum(F.col("skipped").cast("int")).alias("skipped"),
                      F.sum(F.col("minutes_played").cast("decimal(18,2)")).cast("double").alias("minutes")))


def write_batch(out_dir: str) -> Callable[[DataFrame, int], None]:
    """What each micro-batch does with its raw plays."""
    clean_dir, daily_dir = path_join(out_dir, "streaming_clean"), path_join(out_dir, "daily_activity")

    def write(raw: DataFrame, batch: int) -> None:
        spark = raw.sparkSession
        typed = typed_rows(raw).where(F.col("ms_played") >= MIN_MS_PLAYED).dropDuplicates(BASE_COLUMNS)
        fresh = with_derived(typed)
        own = path_join(clean_dir, f"batch={batch}")
        # an empty folder of this batch first, so that the table can be read from the start
        fresh.limit(0).write.mode("overwrite").partitionBy("date").parquet(own)
        schema = fresh.schema.add("batch", "long")
        days = [r.date for r in fresh.select("date").distinct().collect()]  # bounded by the calendar
        touched = F.coalesce(F.col("date").isin(*[d for d in days if d is not None]) if any(days) else F.lit(False),
                             F.lit(None in days))

        def written() -> DataFrame:
            return spark.read.schema(schema).parquet(clean_dir).where(touched)

        before = written().where(F.col("batch") != batch).select(*BASE_COLUMNS)
        same = reduce(lambda a, b: a & b, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in BASE_COLUMNS])
        (fresh.alias("n").join(before.alias("o"), same, "left_anti")
         .write.mode("overwrite").partitionBy("date").parquet(own))
        (daily_activity(written())
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(daily_dir))

    return write


def start(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
          available_now: bool = True) -> tuple[StreamingQuery, ...]:
    """Start the ingest stream; returns its queries."""
    stream = landed_plays(spark, landing_dir).writeStream.foreachBatch(write_batch(out_dir)).option(
        "checkpointLocation", path_join(checkpoint_dir, "clean"))
    stream = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime="1 minute")
    return (stream.start(),)
