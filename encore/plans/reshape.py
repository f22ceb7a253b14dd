"""Result reshapes the dashboard performs (Q25-Q30), as Spark plans over the
query results (each input is already small: grouped query output)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.calendar import SEASONS, WEEKDAYS, rank_of
from encore.functions.labels import period_label
from encore.functions.numeric import half_even, mean_half_even
from encore.plans import listening
from encore.sources.adapters import constant_table
from encore.sources.warehouse import Warehouse

HOUR_COLUMNS = [f"h{h:02d}" for h in range(24)]


def heatmap_grid(wh: Warehouse) -> DataFrame:
    """Day x hour grid of stream counts, rows Monday..Sunday, empty slot NULL."""
    heat = listening.hourly_counts(wh)
    pivoted = (heat.groupBy("day_of_week").pivot("hour", list(range(24)))
                   .agg(F.first("stream_count")))
    pivoted = pivoted.select("day_of_week", *[F.col(str(h)).alias(c) for h, c in enumerate(HOUR_COLUMNS)])
    days = constant_table(wh.spark, ["day_of_week"], [(d,) for d in WEEKDAYS])
    return (days.join(pivoted, "day_of_week", "left")
                .orderBy(rank_of(F.col("day_of_week"), WEEKDAYS)))


def season_summary(wh: Warehouse) -> DataFrame:
    w = listening.weather_groups(wh)
    return (w.groupBy("country", "season").agg(
                mean_half_even(F.col("avg_hours_per_day"), 2, 2).alias("avg_hours"),
                mean_half_even(F.col("avg_temp_c"), 1, 2).alias("avg_temp"),
                mean_half_even(F.col("skip_pct"), 1, 2).alias("skip_pct"))
            .orderBy("country", rank_of(F.col("season"), SEASONS)))


def skip_by_temperature(wh: Warehouse) -> DataFrame:
    w = listening.weather_groups(wh)
    return (w.groupBy("country", "temp_category")
             .agg(mean_half_even(F.col("skip_pct"), 1, 1).alias("skip_pct"))
             .orderBy("country", "temp_category"))


def country_differences(wh: Warehouse) -> DataFrame:
    s = listening.country_rows(wh)
    pick = lambda c, col: F.max(F.when(F.col("country") == c, F.col(col)))
    wide = s.agg(pick("DE", "skip_pct").alias("de_skip_pct"), pick("PK", "skip_pct").alias("pk_skip_pct"),
                 pick("DE", "unique_artists").alias("de_unique_artists"),
                 pick("PK", "unique_artists").alias("pk_unique_artists"),
                 pick("DE", "shuffle_pct").alias("de_shuffle_pct"),
                 pick("PK", "shuffle_pct").alias("pk_shuffle_pct"))
    return wide.select(
        half_even(F.col("de_skip_pct") - F.col("pk_skip_pct"), 1).alias("skip_gap_pp"),
        (F.col("de_unique_artists") - F.col("pk_unique_artists")).alias("artists_gap"),
        "de_skip_pct", "pk_skip_pct", "de_unique_artists", "pk_unique_artists",
        "de_shuffle_pct", "pk_shuffle_pct")


def monthly_period(wh: Warehouse) -> DataFrame:
    m = listening.monthly_trend_rows(wh)
    return (m.withColumn("period", period_label(F.col("year"), F.col("month")))
             .orderBy("year", "month"))


def engagement_scatter(wh: Warehouse) -> DataFrame:
    return listening.top_tracks(wh).where(F.col("completion_pct").isNotNull())


def recent_months(wh: Warehouse, n: int = 6) -> DataFrame:
    """The last ``n`` months of the monthly trend, in calendar order (tail)."""
    last = (listening.monthly_trend_rows(wh)
            .orderBy(F.desc("year"), F.desc("month")).limit(n))
    return last.orderBy("year", "month")


def heatmap_day(wh: Warehouse, day: str = "Monday") -> DataFrame:
    """One weekday's row of the heatmap (hour, day_of_week, stream_count)."""
    return (listening.hourly_counts(wh).where(F.col("day_of_week") == day)  # pushed below the aggregate
            .orderBy("hour"))
