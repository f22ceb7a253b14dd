"""Integrity and quality checks as DataFrames (no asserts, no driver loops).

Each result is a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.numeric import half_even


def integrity_checks(clean: DataFrame, plays: DataFrame, tracks: DataFrame,
                     artists: DataFrame) -> DataFrame:
    """V1-V5: fact rows = clean rows; no orphan track/artist ids; no NULL
    stream ids; no URI twice in the track dimension.

    One pass over the fact, grouped by its two ids map-side; the dimensions are
    joined with the groups and the groups' plays are added up."""
    n = F.count(F.lit(1))
    known = lambda dim, key, flag: dim.select(key).distinct().withColumn(flag, F.lit(True))
    groups = (plays.groupBy("track_id", "artist_id")
                   .agg(n.alias("n"), F.count_if(F.col("stream_id").isNull()).alias("no_id"))
                   .join(known(tracks, "track_id", "has_track"), "track_id", "left")
                   .join(known(artists, "artist_id", "has_artist"), "artist_id", "left"))
    orphans = lambda flag: F.sum(F.when(F.col(flag).isNull(), F.col("n")))
    none = F.lit(0).cast("long")
    clean_rows = clean.agg(n).scalar()
    twice = tracks.groupBy("track_uri").agg(n.alias("n")).where(F.col("n") > 1).agg(n).scalar()
    figures = groups.agg(F.coalesce(F.sum("n"), none).alias("rows"),
                         F.coalesce(orphans("has_track"), none).alias("no_track"),
                         F.coalesce(orphans("has_artist"), none).alias("no_artist"),
                         F.coalesce(F.sum("no_id"), none).alias("no_id"))
    named = [("fact_rows_equal_clean_rows", F.abs(clean_rows - F.col("rows"))),
             ("orphan_track_ids", F.col("no_track")), ("orphan_artist_ids", F.col("no_artist")),
             ("null_stream_ids", F.col("no_id")), ("duplicate_track_uris", twice)]
    return figures.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), value.cast("long").alias("violations")) for name, value in named])))


def metadata_coverage(tracks: DataFrame, metadata: DataFrame) -> DataFrame:
    """V6: requested tracks, rows saved, available, coverage %, missing."""
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    base = metadata.agg(F.count(F.lit(1)).alias("metadata_rows"),
                        F.count_if(F.col("api_available")).alias("api_available"))
    total = n(tracks.where(F.col("track_uri").isNotNull()))
    return base.select(
        total.alias("total_tracks"), "metadata_rows", "api_available",
        F.when(total > 0, half_even(F.col("api_available") / total.cast("double") * 100.0, 1))
         .otherwise(F.lit(0.0)).alias("coverage_pct"),
        (total - F.col("api_available")).alias("missing"),
    )


def weather_nulls(weather: DataFrame) -> DataFrame:
    """V7: row total and NULL counts of the three measures."""
    return weather.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("temp_mean").isNull()).alias("null_temp"),
        F.count_if(F.col("precipitation").isNull()).alias("null_precip"),
        F.count_if(F.col("sunshine_hrs").isNull()).alias("null_sunshine"),
    )
