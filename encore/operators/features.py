"""Track metadata (landed service rows) and behavioural features per track.

Features aggregate the fact by (track, year), then track, so a new year leaves the
others' sums as they are; a year's active days are a set of 366 bits, which needs
neither an Expand nor a shuffle of its own. Durations join at track grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.labels import release_year
from encore.functions.numeric import MINUTES_DECIMAL, exact_sum, sql_round
from encore.functions.text import last_uri_segment

API_COLUMNS = ["track_id", "popularity", "duration_ms", "explicit", "release_date",
               "release_year", "api_available"]
FEATURE_COLUMNS = ["total_plays", "completion_rate", "skip_rate", "shuffle_rate",
                   "avg_plays_per_active_day"]
METADATA_COLUMNS = API_COLUMNS + FEATURE_COLUMNS


def track_api(tracks: DataFrame, landed: DataFrame) -> DataFrame:
    """Every track gets one row; tracks the service did not return (or
    returned as null) are ``api_available = false`` with NULL fields."""
    landed = landed.drop("release_year", "landed_at", "landed_in", "landed_row")
    if "track_uri" in landed.columns:  # rows keyed by URI
        j = tracks.select("track_id", "track_uri").join(landed.drop("track_id"), "track_uri", "left")
    else:  # by the service's id; rows without one by the warehouse id sent in the request
        named = landed.where("source_id is not null").drop("track_id")
        unnamed = landed.where("source_id is null").drop("source_id")
        fields = [c for c in unnamed.columns if c != "track_id"]
        j = (tracks.select("track_id", last_uri_segment(F.col("track_uri")).alias("source_id"))
             .join(named.select("source_id", F.struct(*fields).alias("_named")), "source_id", "left")
             .join(unnamed.select("track_id", F.struct(*fields).alias("_unnamed")), "track_id", "left")
             .select("track_id", F.coalesce("_named", "_unnamed").alias("_row")).select("track_id", "_row.*"))
    ok = F.coalesce(F.col("api_available"), F.lit(False))
    keep = lambda c: F.when(ok, F.col(c))
    return j.select(
        "track_id",
        keep("popularity").cast("int").alias("popularity"),
        keep("duration_ms").cast("long").alias("duration_ms"),
        keep("explicit").alias("explicit"),
        keep("release_date").alias("release_date"),
        F.when(ok & (F.length("release_date") > 0), release_year(F.col("release_date"))).alias("release_year"),
        ok.alias("api_available"),
    )


def completion(total_ms, plays, duration_ms):
    """Mean of ``ms_played / NULLIF(duration_ms, 0)`` over a track's plays.

    A track has one duration, so the mean is one quotient of whole numbers: no
    order of summation, partitioning or join can change it."""
    whole = plays.cast("double") * F.nullif(duration_ms, F.lit(0)).cast("double")
    return total_ms.cast("double") / whole


YEAR_SUMS = ["n", "ms", "minutes", "skipped", "shuffle", "days"]


# The days of a year as bits of six numbers.
DAY_WORDS, DAY_BITS = 6, 61


def track_years(plays: DataFrame) -> DataFrame:
    """Sums per (track, year), active days among them: a day lies in one year, so years
    add up. One aggregate: a hot track collapses map-side, its days to six numbers."""
    day = F.dayofyear("date") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day % DAY_BITS)
    words = [f"_days{i}" for i in range(DAY_WORDS)]
    sums = plays.groupBy("track_id", F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms"),
        exact_sum("minutes_played").cast("decimal(38,2)").alias("minutes"),
        *[F.sum(F.col(c).cast("int")).alias(c) for c in ("skipped", "shuffle")],
        *[F.bit_or(F.when(F.floor(day / DAY_BITS) == i, bit).otherwise(0)).alias(w) for i, w in enumerate(words)])
    days = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0])).cast("long")
    return sums.select("track_id", "year", *YEAR_SUMS[:-1], F.coalesce(days, F.lit(0).cast("long")).alias("days"))


def track_features(plays: DataFrame, api: DataFrame) -> DataFrame:
    return features_of(track_years(plays), api)


def features_of(years: DataFrame, api: DataFrame) -> DataFrame:
    """E5 per track: plays, completion (capped at 1, NULL mean -> 1.0), skip and
    shuffle rates, plays per active day; and the minutes played. The durations join
    the finished tracks."""
    per_track = years.groupBy("track_id").agg(*[F.sum(c).alias(c) for c in YEAR_SUMS])
    mean = completion(F.col("ms"), F.col("n"), F.col("duration_ms"))
    capped = F.least(F.col("mean"), F.lit(1.0))
    n = F.col("n").cast("double")
    return per_track.join(api.select("track_id", "duration_ms"), "track_id", "left").withColumn("mean", mean).select(
        "track_id",
        F.col("n").alias("total_plays"),
        sql_round(capped, 3).alias("completion_rate"),
        sql_round(F.when(F.col("mean").isNotNull(), capped), 3).alias("completion_rate_strict"),
        sql_round(F.col("skipped") / n, 3).alias("skip_rate"),
        sql_round(F.col("shuffle") / n, 3).alias("shuffle_rate"),
        sql_round(n / F.nullif(F.col("days"), F.lit(0)).cast("double"), 2).alias("avg_plays_per_active_day"),
        F.col("minutes").cast(MINUTES_DECIMAL).alias("total_minutes"),
    )


def track_metadata(api: DataFrame, features: DataFrame) -> DataFrame:
    return api.join(features, "track_id", "left").select(*METADATA_COLUMNS, "completion_rate_strict", "total_minutes")
