"""Request manifests for the two external services (what to fetch, not the fetch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.text import last_uri_segment

# Ids per metadata request.
BATCH_SIZE = 50


def track_batches(tracks: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """S13: tracks in id order cut into batches of ``size``.

    Ids are dense 1..n, so the batch number is arithmetic on the id; each
    group holds at most ``size`` rows.
    """
    t = (tracks.where(F.col("track_uri").isNotNull())
               .select("track_id", last_uri_segment(F.col("track_uri")).alias("source_id"))
               .withColumn("batch_id", F.floor((F.col("track_id") - 1) / size).cast("long")))
    items = F.array_sort(F.collect_list(F.struct("track_id", "source_id")))
    return (t.groupBy("batch_id")
             .agg(items.alias("items"))
             .select("batch_id",
                     F.size("items").cast("long").alias("n_tracks"),
                     F.col("items")[0]["track_id"].alias("first_track_id"),
                     F.element_at("items", -1)["track_id"].alias("last_track_id"),
                     F.array_join(F.transform("items", lambda x: x["source_id"]), ",").alias("source_ids")))
