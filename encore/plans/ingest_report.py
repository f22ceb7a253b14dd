"""Ingest summary figures (Q22-Q24) over the clean table.

These follow the original report's pandas rules: distinct counts are over
names (NULLs ignored), and rounding is half-even on the binary value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.numeric import exact_sum, half_even
from encore.sources.warehouse import Warehouse

def n_rows():
    return F.count(F.lit(1))


def _reduced(clean: DataFrame, *names: str) -> DataFrame:
    """Plays per (year, ``names``), grouped map-side: distinct counts over these
    rows copy a row per group, not per play."""
    flag = lambda c: F.sum(F.col(c).cast("int")).alias(f"n_{c}")
    return clean.groupBy("year", *names).agg(
        n_rows().alias("n"), F.count("played_at").alias("timed"), exact_sum("minutes_played").alias("minutes"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        flag("skipped"), flag("shuffle"), flag("offline"))


def _mean_pct(col: str):
    return half_even(F.sum(f"n_{col}").cast("double") / F.sum("n").cast("double") * F.lit(100.0), 1)


def _hours():
    return half_even(F.sum("minutes").cast("double") / F.lit(60.0), 1)


def ingest_summary(wh: Warehouse) -> DataFrame:
    return _reduced(wh.clean, "artist_name", "track_name", "album_name").agg(
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.array_join(F.sort_array(F.collect_set(F.col("year").cast("string"))), ",").alias("years"),
        _hours().alias("total_hours"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_streams"),
        F.countDistinct("artist_name").alias("unique_artists"),
        F.countDistinct("track_name").alias("unique_tracks"),
        F.countDistinct("album_name").alias("unique_albums"),
        _mean_pct("skipped").alias("skip_pct"),
        _mean_pct("shuffle").alias("shuffle_pct"),
        _mean_pct("offline").alias("offline_pct"),
    )


def ingest_by_year(wh: Warehouse) -> DataFrame:
    return (_reduced(wh.clean, "artist_name", "track_name").groupBy("year").agg(
                F.sum("timed").alias("streams"),
                _hours().alias("hours"),
                F.countDistinct("artist_name").alias("unique_artists"),
                F.countDistinct("track_name").alias("unique_tracks"),
                _mean_pct("skipped").alias("skip_rate"))
            .orderBy("year"))


def country_counts(wh: Warehouse, n: int = 10) -> DataFrame:
    return (wh.clean.groupBy("country").agg(n_rows().alias("streams"))
            .orderBy(F.desc("streams"), "country").limit(n))


def platform_counts(wh: Warehouse) -> DataFrame:
    return (wh.clean.groupBy("platform_group").agg(n_rows().alias("streams"))
            .orderBy(F.desc("streams"), "platform_group"))
