"""What reports add up instead of reading plays: an additive roll-up, bitmaps of
the dense ids for exact distinct counts, and sketches for approximate ones.

* ``activity``: plays, minutes, skips and shuffles per (date, hour, country) with the
  calendar columns. At most a row per hour of the calendar and country.
* ``id_bitmaps``: per (year, country) and kind of id (track, artist) the set of ids, 32,768
  to a bitmap. Sets are merged by OR, so any grouping by year and country counts
  its distinct ids exactly, without copying plays per distinct count.
* ``id_sketches``: the same by HLL sketches, some 2 % off, of fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.numeric import exact_sum

SLOT = ["date", "hour", "country", "year", "month", "month_name", "day_of_week"]
KINDS = {"artist_id": "unique_artists", "track_id": "unique_tracks"}


def activity(plays: DataFrame) -> DataFrame:
    return plays.groupBy(*SLOT).agg(
        F.count(F.lit(1)).alias("n"), exact_sum("minutes_played").alias("minutes"),
        F.sum(F.col("skipped").cast("int")).alias("n_skip"), F.sum(F.col("shuffle").cast("int")).alias("n_shuffle"))


def id_groups(plays: DataFrame) -> DataFrame:
    """Distinct (year, country, artist, track): repeats of a hot track collapse map-side."""
    return plays.select("year", "country", *KINDS).distinct()


def id_bitmaps(groups: DataFrame) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("id")) for k in KINDS])
    ids = groups.select("year", "country", F.inline(kinds)).distinct()
    return (ids.groupBy("year", "country", "kind", F.bitmap_bucket_number("id").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))


def id_sketches(groups: DataFrame) -> DataFrame:
    return groups.groupBy("year", "country").agg(*[F.hll_sketch_agg(k).alias(k) for k in KINDS])


def distinct_ids(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Exact number of distinct ids per ``by`` (year, country, both or none)."""
    merged = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    none = F.lit(0).cast("long")
    return merged.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), none).alias(name) for k, name in KINDS.items()])


def estimated_ids(sketches: DataFrame, *by: str) -> DataFrame:
    """``distinct_ids`` by sketches: approximate, of bounded size whatever the ids."""
    none = F.lit(0).cast("long")
    return sketches.groupBy(*by).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(k)), none).alias(name) for k, name in KINDS.items()])
