"""Build-time previews (Q13-Q21): star, metadata and weather summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.numeric import exact_mean, exact_sum, sql_round
from encore.plans.listening import (n_rows, _added_pct, _hours, _named_tracks, _pct, _season_order,
                                    artist_totals, plays_in, weather_days)
from encore.sources.warehouse import Warehouse


def preview_top_artists(wh: Warehouse, n: int = 5) -> DataFrame:
    return (artist_totals(wh)
            .select("artist_name", _hours(F.col("minutes")).alias("hours"),
                    F.col("streams").alias("streams"))
            .orderBy(F.desc("hours"), F.asc("artist_name"))
            .limit(n))


def _by(wh: Warehouse, key: str) -> DataFrame:
    return wh.activity.groupBy(key).agg(
        plays_in().alias("streams"), _hours(F.sum("minutes")).alias("hours"), _added_pct("n_skip").alias("skip_pct"))


def preview_by_year(wh: Warehouse) -> DataFrame:
    return _by(wh, "year").orderBy("year")


def preview_by_country(wh: Warehouse) -> DataFrame:
    return _by(wh, "country").orderBy(F.desc("streams"), "country")


def popular_tracks(wh: Warehouse, n: int = 8) -> DataFrame:
    m = wh.track_metadata.where(F.col("api_available"))
    return (_named_tracks(wh, m)
            .orderBy(F.desc("popularity"), F.asc("track_name"), F.asc("artist_name"), F.asc("track_id"))
            .limit(n)
            .select("track_name", "artist_name", "popularity", "release_year", "total_plays"))


def most_completed(wh: Warehouse, n: int = 8) -> DataFrame:
    m = wh.track_metadata.where((F.col("total_plays") >= 5) & F.col("completion_rate").isNotNull())
    return (_named_tracks(wh, m)
            .orderBy(F.desc("completion_rate"), F.desc("total_plays"), F.asc("track_name"),
                     F.asc("artist_name"), F.asc("track_id"))
            .limit(n)
            .select("track_name", "artist_name",
                    sql_round(F.col("completion_rate") * F.lit(100.0), 1).alias("completion_pct"),
                    "total_plays"))


def most_skipped(wh: Warehouse, n: int = 8) -> DataFrame:
    m = wh.track_metadata.where(F.col("total_plays") >= 5)
    return (_named_tracks(wh, m)
            .orderBy(F.desc("skip_rate"), F.desc("total_plays"), F.asc("track_name"),
                     F.asc("artist_name"), F.asc("track_id"))
            .limit(n)
            .select("track_name", "artist_name",
                    sql_round(F.col("skip_rate") * F.lit(100.0), 1).alias("skip_pct"),
                    "total_plays"))


def weather_by_season(wh: Warehouse) -> DataFrame:
    """Day grain: one row per weather day (rainy_days counts days)."""
    return (wh.weather.groupBy("country", "season").agg(
                sql_round(exact_mean("temp_mean"), 1).alias("avg_temp_c"),
                sql_round(exact_mean("precipitation"), 1).alias("avg_rain_mm"),
                sql_round(exact_mean("sunshine_hrs"), 1).alias("avg_sunshine_hrs"),
                F.sum(F.col("is_rainy").cast("int")).cast("long").alias("rainy_days"),
                n_rows().alias("total_days"))
            .orderBy("country", _season_order()))


def weather_hours(wh: Warehouse) -> DataFrame:
    g = weather_days(wh).groupBy("country", "season", "temp_category").agg(
        n_rows().alias("weather_days"),
        F.sum("n").alias("total_streams"),
        _hours(F.sum("minutes")).alias("hours_listened"),
        _pct(F.sum("n_skip").cast("double") / F.sum("n").cast("double")).alias("skip_pct"))
    return g.orderBy("country", F.desc("hours_listened"), _season_order(), "temp_category")


def weather_coverage(wh: Warehouse) -> DataFrame:
    return (wh.weather.groupBy("country", "city").agg(
                n_rows().alias("days"), F.min("date").alias("from_date"), F.max("date").alias("to_date"))
            .orderBy("country"))
