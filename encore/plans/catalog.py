"""Registry: query key -> plan over the warehouse.

Keys follow the workload's tables, checks, queries, previews and reshapes.
``for_tables()`` binds each to a folder of test tables: the warehouse for
that folder is built once (reused within and across sessions while inputs
and build code are unchanged) and every query reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import checks, clean as clean_op, manifests
from encore.operators import weather as weather_op
from encore.operators.features import FEATURE_COLUMNS, METADATA_COLUMNS
from encore.plans import ingest_report, listening, previews, reshape
from encore.sources.warehouse import Warehouse, warehouse_for


def _weather(wh: Warehouse, strict: bool) -> DataFrame:
    cols = [F.col("temp_category_strict").alias("temp_category") if (strict and c == "temp_category")
            else F.col(c) for c in weather_op.WEATHER_COLUMNS]
    return wh.weather.select(*cols)


QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # ingest
    "clean_plays": lambda wh: wh.clean.select(*clean_op.CLEAN_COLUMNS),
    "removed_rows": lambda wh: clean_op.removed_rows(wh.raw_counts, wh.clean),
    "platform_counts": ingest_report.platform_counts,
    "country_counts": ingest_report.country_counts,
    "ingest_summary": ingest_report.ingest_summary,
    "ingest_by_year": ingest_report.ingest_by_year,
    # star
    "dim_artists": lambda wh: wh.dim_artists.select("artist_id", "artist_name"),
    "dim_tracks": lambda wh: wh.dim_tracks.select("track_id", "track_uri", "track_name", "album_name", "artist_id"),
    "dim_date": lambda wh: wh.dim_date(),
    "fact_streams": lambda wh: wh.fact_streams(),
    "integrity_checks": lambda wh: checks.integrity_checks(wh.clean, wh.plays, wh.dim_tracks, wh.dim_artists),
    # dashboard queries
    "summary_stats": listening.summary_stats,
    "top_artists": listening.top_artists,
    "top_tracks": listening.top_tracks,
    "hourly_heatmap": listening.hourly_heatmap,
    "monthly_trend": listening.monthly_trend,
    "year_comparison": listening.year_comparison,
    "skip_analysis": listening.skip_analysis,
    "completion_leaders": listening.completion_leaders,
    "hidden_gems": listening.hidden_gems,
    "country_summary": listening.country_summary,
    "country_top_artists": listening.country_top_artists,
    "country_peak_hours": listening.country_peak_hours,
    "weather_listening": listening.weather_listening,
    "rainy_vs_dry": listening.rainy_vs_dry,
    # previews
    "preview_top_artists": previews.preview_top_artists,
    "preview_by_year": previews.preview_by_year,
    "preview_by_country": previews.preview_by_country,
    # metadata
    "track_metadata": lambda wh: wh.track_metadata.select(*METADATA_COLUMNS),
    "track_features": lambda wh: (wh.track_metadata.where(F.col("total_plays").isNotNull())
                                  .select("track_id", *FEATURE_COLUMNS)),
    "metadata_coverage": lambda wh: checks.metadata_coverage(wh.dim_tracks, wh.track_metadata),
    "track_request_batches": lambda wh: manifests.track_batches(wh.dim_tracks),
    "popular_tracks": previews.popular_tracks,
    "most_completed": previews.most_completed,
    "most_skipped": previews.most_skipped,
    # weather
    "dim_weather": lambda wh: _weather(wh, strict=False),
    "weather_request_ranges": lambda wh: weather_op.request_ranges(wh.plays, wh.coords),
    "weather_nulls": lambda wh: checks.weather_nulls(wh.weather),
    "weather_by_season": previews.weather_by_season,
    "weather_hours": previews.weather_hours,
    "weather_coverage": previews.weather_coverage,
    # dashboard reshapes
    "heatmap_grid": reshape.heatmap_grid,
    "season_summary": reshape.season_summary,
    "skip_by_temperature": reshape.skip_by_temperature,
    "country_differences": reshape.country_differences,
    "monthly_period": reshape.monthly_period,
    "engagement_scatter": reshape.engagement_scatter,
    "recent_months": reshape.recent_months,
    "heatmap_monday": reshape.heatmap_day,
    # strict variants (NULL instead of the original's fall-through values)
    "completion_leaders_strict": lambda wh: listening.completion_leaders(wh, strict=True),
    "dim_weather_strict": lambda wh: _weather(wh, strict=True),
}


def for_tables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(warehouse_for(spark, sf_dir))
    return {k: bind(fn) for k, fn in QUERIES.items()}
