"""The twelve dashboard queries (Q1-Q12) over the warehouse.

Conventions:
* ``plays`` is the fact carrying its calendar columns (no 1:1 date join).
* Figures by time and country add up the build's roll-up (``activity``); distinct
  tracks and artists by year and country come from its bitmaps. Only queries that name
  tracks or artists read plays.
* Hours and average minutes come from exact decimal sums (order-independent).
* Every top-k / rank has a total order: the original key first, then names
  ascending (then ids) as tie-breaks; the oracle SQL states the same order.
* Weather queries add the roll-up to (country, date) first; the join then
  touches countries x days rows, and play-weighted averages are rebuilt from
  per-day play counts (weights), so results equal the play-grain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.calendar import SEASONS, WEEKDAYS, rank_of
from encore.functions.numeric import MINUTES_DECIMAL, exact_sum, sql_round
from encore.operators import rollup
from encore.sources.warehouse import Warehouse, focus

def n_rows():
    return F.count(F.lit(1))


def _hours(minutes_sum, k: int = 1):
    return sql_round(minutes_sum.cast("double") / F.lit(60.0), k)


def _pct(avg_expr, k: int = 1):
    return sql_round(avg_expr * F.lit(100.0), k)


def _skip_avg():
    return F.avg(F.col("skipped").cast("int"))


def _ratio(num, den):
    return num.cast("double") / den.cast("double")


def plays_in():
    """Plays of roll-up rows."""
    return F.coalesce(F.sum("n"), F.lit(0).cast("long"))


def added(rows: DataFrame, *by: str, skip_name: str = "skip_pct") -> DataFrame:
    """Totals of roll-up rows."""
    return rows.groupBy(*by).agg(
        plays_in().alias("total_streams"), _hours(F.sum("minutes")).alias("total_hours"),
        _added_pct("n_skip").alias(skip_name), _added_pct("n_shuffle").alias("shuffle_pct"))


def _added_pct(flag: str):
    return _pct(_ratio(F.sum(flag), F.sum("n")))


def _uniques(wh: Warehouse, *by: str, approximate: bool = False, only=None) -> DataFrame:
    """Distinct artists and tracks; approximate ones (HLL) on request."""
    source = wh.id_sketches if approximate else wh.id_bitmaps
    source = source if only is None else only(source)
    return (rollup.estimated_ids if approximate else rollup.distinct_ids)(source, *by)


# Q1 -------------------------------------------------------------------------
def summary_stats(wh: Warehouse, approximate: bool = False) -> DataFrame:
    a = wh.activity
    # arg-max of streams per country, ties to the smallest country code
    top = (a.groupBy("country").agg(plays_in().alias("n"))
            .agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("country").alias("c"))).getField("c"))
            .scalar())
    uniques = _uniques(wh, approximate=approximate)
    one = lambda c: uniques.select(c).scalar().alias(c)
    years = a.agg(F.countDistinct("year")).scalar()
    return added(a, skip_name="overall_skip_pct").select(
        "total_streams", "total_hours", one("unique_artists"), one("unique_tracks"), "overall_skip_pct", "shuffle_pct",
        years.alias("years_covered"), top.alias("top_country"))


# Q2 -------------------------------------------------------------------------
def artist_totals(wh: Warehouse) -> DataFrame:
    per_artist = wh.plays.groupBy("artist_id").agg(
        exact_sum("minutes_played").alias("minutes"),
        n_rows().alias("streams"),
        _skip_avg().alias("skip_avg"),
        F.countDistinct("track_id").alias("unique_tracks"),
    )
    return per_artist.join(wh.dim_artists, "artist_id")


def top_artists(wh: Warehouse, n: int = 15) -> DataFrame:
    return (artist_totals(wh)
            .select("artist_name",
                    _hours(F.col("minutes")).alias("hours_listened"),
                    F.col("streams").alias("total_streams"),
                    _pct(F.col("skip_avg")).alias("skip_pct"),
                    "unique_tracks")
            .orderBy(F.desc("hours_listened"), F.asc("artist_name"))
            .limit(n))


# Q3 -------------------------------------------------------------------------
def track_groups(wh: Warehouse) -> DataFrame:
    """Plays grouped by (track name, play's artist name, completion rate)."""
    pre = wh.plays.groupBy("track_id", "artist_id").agg(
        n_rows().alias("n"), F.sum(F.col("skipped").cast("int")).alias("n_skip"),
        exact_sum("minutes_played").alias("minutes"))
    j = (pre.join(wh.dim_tracks.select("track_id", "track_name"), "track_id")
            .join(wh.dim_artists, "artist_id")
            .join(wh.track_metadata.select("track_id", "completion_rate"), "track_id", "left"))
    return j.groupBy("track_name", "artist_name", "completion_rate").agg(
        F.sum("n").alias("total_plays"), F.sum("n_skip").alias("n_skip"),
        F.sum("minutes").alias("minutes"))


def top_tracks(wh: Warehouse, n: int = 15) -> DataFrame:
    g = track_groups(wh).where(F.col("total_plays") >= 3)
    return (g.orderBy(F.desc("total_plays"), F.asc("track_name"), F.asc("artist_name"),
                      F.asc_nulls_last("completion_rate"))
             .limit(n)
             .select("track_name", "artist_name",
                     F.col("total_plays").cast("long").alias("total_plays"),
                     sql_round(F.col("completion_rate") * F.lit(100.0), 1).alias("completion_pct"),
                     _pct(_ratio(F.col("n_skip"), F.col("total_plays"))).alias("skip_pct"),
                     _hours(F.col("minutes"), 2).alias("hours_listened")))


# Q4-Q7 ----------------------------------------------------------------------
def hourly_counts(wh: Warehouse) -> DataFrame:
    return wh.activity.groupBy("hour", "day_of_week").agg(plays_in().alias("stream_count"))


def hourly_heatmap(wh: Warehouse) -> DataFrame:
    return hourly_counts(wh).orderBy(rank_of(F.col("day_of_week"), WEEKDAYS), "hour")


def monthly_trend_rows(wh: Warehouse) -> DataFrame:
    return wh.activity.groupBy("year", "month", "month_name").agg(
        _hours(F.sum("minutes")).alias("hours_listened"),
        plays_in().alias("stream_count"),
        _added_pct("n_skip").alias("skip_pct"))


def monthly_trend(wh: Warehouse) -> DataFrame:
    return monthly_trend_rows(wh).orderBy("year", "month")


def _with_uniques(figures: DataFrame, uniques: DataFrame, by: str) -> DataFrame:
    # a row per year or country on both sides
    return figures.join(uniques, by).select(by, "total_streams", "total_hours", "unique_artists", "unique_tracks",
                                            "skip_pct", "shuffle_pct")


def year_comparison(wh: Warehouse, approximate: bool = False) -> DataFrame:
    return _with_uniques(added(wh.activity, "year"), _uniques(wh, "year", approximate=approximate), "year").orderBy("year")


def skip_analysis(wh: Warehouse) -> DataFrame:
    return (focus(wh.activity).groupBy("year", "country").agg(
                plays_in().alias("total_streams"),
                F.sum("n_skip").alias("skipped_count"),
                _added_pct("n_skip").alias("skip_pct"),
                sql_round(_ratio(F.sum("minutes"), F.sum("n")), 2).alias("avg_mins_played"))
            .orderBy("year", "country"))


# Q8, Q9 ---------------------------------------------------------------------
def _named_tracks(wh: Warehouse, meta: DataFrame) -> DataFrame:
    """Metadata rows with the track's name and the *track's* artist name."""
    return (meta.join(wh.dim_tracks.select("track_id", "track_name", "artist_id"), "track_id")
                .join(wh.dim_artists, "artist_id"))


def completion_leaders(wh: Warehouse, n: int = 15, strict: bool = False) -> DataFrame:
    rate = "completion_rate_strict" if strict else "completion_rate"
    m = (wh.track_metadata.where((F.col("total_plays") >= 5) & F.col(rate).isNotNull())
         .select("track_id", F.col(rate).alias("completion_rate"), "total_plays", "total_minutes"))
    # tracks of one name, artist and figures are one row; the build stored each track's minutes
    g = _named_tracks(wh, m).groupBy("track_name", "artist_name", "completion_rate", "total_plays").agg(
        F.sum("total_minutes").alias("minutes"), (F.count(F.lit(1)) * F.col("total_plays")).alias("n"))
    return (g.orderBy(F.desc("completion_rate"), F.desc("total_plays"),
                      F.asc("track_name"), F.asc("artist_name"))
             .limit(n)
             .select("track_name", "artist_name",
                     sql_round(F.col("completion_rate") * F.lit(100.0), 1).alias("completion_pct"),
                     "total_plays",
                     sql_round(_ratio(F.col("minutes"), F.col("n")), 2).alias("avg_mins_played")))


def hidden_gems(wh: Warehouse, n: int = 15) -> DataFrame:
    m = wh.track_metadata.where(F.col("total_plays").between(3, 15)
                                & (F.col("completion_rate") >= 0.90)
                                & (F.col("skip_rate") <= 0.10))
    return (_named_tracks(wh, m)
            .orderBy(F.desc("completion_rate"), F.desc("total_plays"), F.asc("track_name"),
                     F.asc("artist_name"), F.asc("track_id"))
            .limit(n)
            .select("track_name", "artist_name", "total_plays",
                    sql_round(F.col("completion_rate") * F.lit(100.0), 1).alias("completion_pct"),
                    sql_round(F.col("skip_rate") * F.lit(100.0), 1).alias("skip_pct")))


# Q10 ------------------------------------------------------------------------
def country_summary(wh: Warehouse) -> DataFrame:
    return country_rows(wh).orderBy(F.desc("total_streams"), "country")


def country_rows(wh: Warehouse, approximate: bool = False) -> DataFrame:
    f = focus(wh.activity)
    peak = (f.groupBy("country", "hour").agg(plays_in().alias("n"))
             .groupBy("country")
             .agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("hour").alias("h")))
                  .getField("h").alias("peak_hour")))
    uniques = _uniques(wh, "country", approximate=approximate, only=focus)
    return _with_uniques(added(f, "country"), uniques, "country").join(peak, "country")


def country_top_artists(wh: Warehouse, k: int = 8) -> DataFrame:
    g = (focus(wh.plays).groupBy("country", "artist_id").agg(
            exact_sum("minutes_played").alias("minutes"), n_rows().alias("streams"),
            _skip_avg().alias("skip_avg"))
         .join(wh.dim_artists, "artist_id"))
    w = Window.partitionBy("country").orderBy(F.desc("minutes"), F.asc("artist_name"))
    return (g.withColumn("country_rank", F.row_number().over(w))
             .where(F.col("country_rank") <= k)
             .select("country", "artist_name", _hours(F.col("minutes")).alias("hours_listened"),
                     "streams", _pct(F.col("skip_avg")).alias("skip_pct"),
                     F.col("country_rank").cast("long").alias("country_rank"))
             .orderBy("country", "country_rank"))


def country_peak_hours(wh: Warehouse, k: int = 5) -> DataFrame:
    g = focus(wh.activity).groupBy("country", "hour").agg(plays_in().alias("streams"))
    w = Window.partitionBy("country").orderBy(F.desc("streams"), F.asc("hour"))
    return (g.withColumn("hour_rank", F.row_number().over(w))
             .where(F.col("hour_rank") <= k)
             .select("country", "hour", "streams", F.col("hour_rank").cast("long").alias("hour_rank"))
             .orderBy("country", "hour_rank"))


def listening_by_country(wh: Warehouse) -> dict[str, DataFrame]:
    return {"summary": country_summary(wh), "top_artists": country_top_artists(wh),
            "peak_hours": country_peak_hours(wh)}


# Q11, Q12 -------------------------------------------------------------------
def weather_days(wh: Warehouse) -> DataFrame:
    """Weather days with that day's plays in that country (play counts as weights)."""
    day = focus(wh.activity).groupBy("country", "date").agg(
        plays_in().alias("n"), F.sum("n_skip").alias("n_skip"), F.sum("minutes").alias("minutes"))
    # both sides hold at most a row per focus country and day
    return wh.weather.join(day, ["country", "date"])


def _weighted(col: str):
    """Play-weighted exact sum and weight of a 1-2 decimal weather measure."""
    present = F.col(col).isNotNull()
    num = F.sum(F.when(present, F.col(col).cast(MINUTES_DECIMAL) * F.col("n")))
    den = F.sum(F.when(present, F.col("n")))
    return sql_round(_ratio(num, den), 1)


def _season_order():
    return rank_of(F.col("season"), SEASONS)


def weather_listening(wh: Warehouse) -> DataFrame:
    return weather_groups(wh).orderBy("country", _season_order(), "temp_category")


def weather_groups(wh: Warehouse) -> DataFrame:
    g = weather_days(wh).groupBy("country", "season", "temp_category").agg(
        n_rows().alias("total_days"),
        F.sum(F.when(F.col("is_rainy"), F.col("n")).otherwise(0)).cast("long").alias("rainy_days"),
        F.sum("n").alias("streams"), F.sum("minutes").alias("minutes"),
        F.sum("n_skip").alias("n_skip"),
        _weighted("temp_mean").alias("avg_temp_c"),
        _weighted("sunshine_hrs").alias("avg_sunshine_hrs"))
    days = F.col("total_days").cast("double")
    return (g.select("country", "season", "temp_category", "total_days", "rainy_days",
                     sql_round(F.col("streams").cast("double") / days, 1).alias("avg_streams_per_day"),
                     sql_round(F.col("minutes").cast("double") / F.lit(60.0) / days, 2).alias("avg_hours_per_day"),
                     _pct(_ratio(F.col("n_skip"), F.col("streams"))).alias("skip_pct"),
                     "avg_temp_c", "avg_sunshine_hrs"))


def rainy_vs_dry(wh: Warehouse) -> DataFrame:
    g = weather_days(wh).groupBy("country", "season", "is_rainy").agg(
        n_rows().alias("total_days"),
        F.sum("n").alias("streams"), F.sum("minutes").alias("minutes"),
        F.sum("n_skip").alias("n_skip"),
        _weighted("precipitation").alias("avg_precipitation_mm"),
        _weighted("temp_mean").alias("avg_temp_c"))
    days = F.col("total_days").cast("double")
    return (g.orderBy("country", _season_order(), F.desc("is_rainy"))
             .select("country", "season",
                     F.when(F.col("is_rainy"), "Rainy").otherwise("Dry").alias("day_type"),
                     "total_days",
                     sql_round(F.col("streams").cast("double") / days, 1).alias("avg_streams_per_day"),
                     sql_round(F.col("minutes").cast("double") / F.lit(60.0) / days, 2).alias("avg_hours_per_day"),
                     _pct(_ratio(F.col("n_skip"), F.col("streams"))).alias("skip_pct"),
                     "avg_precipitation_mm", "avg_temp_c"))
