"""Daily weather dimension: delivered rows + labels, kept only for
(country, day) pairs with listening in that country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import labels
from encore.sources.landed import newest, sunshine_hours

# Countries whose listening is compared and that have a city.
FOCUS_COUNTRIES = ["DE", "PK"]

WEATHER_COLUMNS = ["date", "temp_max", "temp_min", "temp_mean", "precipitation",
                   "sunshine_hrs", "wind_speed_max", "country", "city",
                   "is_rainy", "temp_category", "season"]


def listening_days(plays: DataFrame) -> DataFrame:
    """Distinct (country, date) with plays in the focus countries.

    Bounded by countries x calendar days, so it is safe to broadcast."""
    return (plays.where(F.col("country").isin(*FOCUS_COUNTRIES))
                 .select("country", "date").distinct())


def labelled(rows: DataFrame) -> DataFrame:
    temp = F.col("temp_mean")
    return rows.select(
        "date", "temp_max", "temp_min", "temp_mean", "precipitation",
        sunshine_hours(F.col("sunshine_duration")).alias("sunshine_hrs"),
        "wind_speed_max", "country", "city",
        labels.is_rainy(F.col("precipitation")).alias("is_rainy"),
        labels.temp_category(temp).alias("temp_category"),
        labels.season(F.month("date")).alias("season"),
        labels.temp_category(temp, strict=True).alias("temp_category_strict"),
    )


def one_per_day(rows: DataFrame) -> DataFrame:
    """One row per (country, date): of a day that landed more than once, the newest
    (where and when are unknown: the greatest by its measures, NULL the smallest)."""
    return newest(rows, ["country", "date"])


def dim_weather(rows: DataFrame, plays: DataFrame) -> DataFrame:
    return labelled(one_per_day(rows)).join(F.broadcast(listening_days(plays)), ["country", "date"], "left_semi")


def request_ranges(plays: DataFrame, coords: DataFrame) -> DataFrame:
    """S14: one request per focus country that has coordinates."""
    spans = (plays.where(F.col("country").isin(*FOCUS_COUNTRIES))
                  .groupBy("country")
                  .agg(F.min("date").alias("start"), F.max("date").alias("end"),
                       F.countDistinct("date").alias("active_days")))
    return (spans.join(F.broadcast(coords), "country")
                 .select("country", "city", "lat", "lon",
                         F.date_format("start", "yyyy-MM-dd").alias("start_date"),
                         F.date_format("end", "yyyy-MM-dd").alias("end_date"),
                         "active_days"))
