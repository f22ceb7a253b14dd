"""Parsers for service responses landed as JSON files.

The network clients themselves are not part of this package: responses are
fetched elsewhere and landed in a folder; these readers turn them into rows.

* weather: ``{country, city, daily: {time: [...], temperature_2m_max: [...], ...}}``
  -> one row per day (parallel arrays zipped, NULL elements kept).
* track metadata: ``{track_ids: [...], tracks: [{popularity, duration_ms,
  explicit, album: {release_date}} | null, ...]}`` -> one row per requested id,
  paired by position; a NULL element means "not available".

Every row carries when and where it landed (file modification time, path). Of
several rows under one key the newest counts (``newest``), whatever order files
are read in; ``merged`` brings newly landed rows into a stored table alike, so an
older file that arrives late changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions import numeric
from encore.functions.labels import release_year

_D = T.ArrayType(T.DoubleType())
WEATHER_SCHEMA = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_max", _D),
        T.StructField("temperature_2m_min", _D),
        T.StructField("temperature_2m_mean", _D),
        T.StructField("precipitation_sum", _D),
        T.StructField("sunshine_duration", _D),
        T.StructField("wind_speed_10m_max", _D),
    ])),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("track_ids", T.ArrayType(T.LongType())),
    T.StructField("source_ids", T.ArrayType(T.StringType())),
    T.StructField("tracks", T.ArrayType(T.StructType([
        T.StructField("popularity", T.IntegerType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("explicit", T.BooleanType()),
        T.StructField("album", T.StructType([T.StructField("release_date", T.StringType())])),
    ]))),
])


# When, in which file and at which place of it a row landed: the order of answers.
LANDING = {"landed_at": "timestamp", "landed_in": "string", "landed_row": "bigint"}


def _read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # a file is read whole by one task, so the rising id orders its payloads
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
            .select("*", F.col("_metadata.file_modification_time").alias("landed_at"),
                    F.col("_metadata.file_path").alias("landed_in"), F.monotonically_increasing_id().alias("landed_row")))


def _with_landing(payloads: DataFrame) -> DataFrame:
    """Payloads of unknown origin are the oldest."""
    return payloads.withColumns({c: F.lit(None).cast(t) for c, t in LANDING.items() if c not in payloads.columns})


def newest(rows: DataFrame, keys: list[str], first: list[str] = ()) -> DataFrame:
    """One row per ``keys`` (NULLs are a key): the greatest by ``first``, then the newest;
    landed at once, the greatest by its fields."""
    others = [c for c in rows.columns if c not in keys]
    landing = [c for c in LANDING if c in others]
    order = F.struct(*[F.col(c) for c in [*first, *landing, *others]])
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_best"))
    return best.select(*keys, "_best.*").select(*rows.columns)


def merged(stored: DataFrame, fresh: DataFrame, keys: list[str], first: list[str] = ()) -> DataFrame:
    """Stored rows with newly landed ones: per key the newest of both."""
    return newest(stored.unionByName(fresh), keys, first)


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, WEATHER_SCHEMA)


def weather_rows(payloads: DataFrame) -> DataFrame:
    """Landed weather payloads -> daily rows in the delivered units.

    A payload without daily values is an error, as an empty response is.
    """
    d = F.col("daily")
    zipped = F.arrays_zip(
        d["time"].alias("time"),
        d["temperature_2m_max"].alias("temp_max"),
        d["temperature_2m_min"].alias("temp_min"),
        d["temperature_2m_mean"].alias("temp_mean"),
        d["precipitation_sum"].alias("precipitation"),
        d["sunshine_duration"].alias("sunshine_duration"),
        d["wind_speed_10m_max"].alias("wind_speed_max"),
    )
    checked = _with_landing(payloads).withColumn(
        "_ok", F.when(F.coalesce(F.size(d["time"]), F.lit(-1)) > 0, F.lit(True))
                .otherwise(F.raise_error(F.concat(F.lit("no daily data returned for "),
                                                  F.coalesce(F.col("city"), F.lit("?"))))))
    return (checked.where(F.col("_ok")).select("country", "city", *LANDING, F.inline(zipped))
            .select(F.to_date("time").alias("date"), "temp_max", "temp_min", "temp_mean",
                    "precipitation", "sunshine_duration", "wind_speed_max", "country", "city", *LANDING))


def sunshine_hours(seconds: Column) -> Column:
    """Seconds -> hours, 2 decimals by the exact binary value (NULL stays NULL)."""
    return numeric.decimal_round(seconds / F.lit(3600.0), 2)


def read_metadata_json(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, METADATA_SCHEMA)


def metadata_rows(payloads: DataFrame) -> DataFrame:
    """Landed metadata batches -> one row per requested track.

    A track is known by the service's own id (``source_id``), which stays the
    same over rebuilds; batches landed without source ids go by the warehouse id
    of their build. Of several answers for one track the newest counts; a missing
    answer is none, so it never replaces one.
    """
    pairs = F.arrays_zip(F.col("track_ids").alias("track_id"), F.col("source_ids").alias("source_id"),
                         F.col("tracks").alias("track"))
    filled = _with_landing(payloads).withColumns({
        "source_ids": F.coalesce("source_ids", F.array().cast("array<string>")),
        "track_ids": F.coalesce("track_ids", F.array().cast("array<bigint>"))})
    answers = (filled.select(*LANDING, F.posexplode(pairs).alias("_place", "_pair"))
               .select("_pair.source_id", F.when(F.col("_pair.source_id").isNull(), F.col("_pair.track_id")).alias("_unnamed"),
                       F.col("_pair.track").isNotNull().alias("_answered"), *LANDING, "_place", "_pair.track_id", "_pair.track")
               .where(F.col("track_id").isNotNull() | F.col("source_id").isNotNull()))
    rows = newest(answers, ["source_id", "_unnamed"], ["_answered"])
    t = F.col("track")
    available = t.isNotNull()
    date = t["album"]["release_date"]
    return rows.select(
        "track_id", "source_id",
        t["popularity"].alias("popularity"),
        t["duration_ms"].alias("duration_ms"),
        t["explicit"].alias("explicit"),
        date.alias("release_date"),
        F.when(F.length(date) > 0, release_year(date)).alias("release_year"),
        available.alias("api_available"),
        *LANDING,
    )


METADATA_KEYS, WEATHER_KEYS = ["source_id", "track_id"], ["country", "date"]


def stored_metadata(rows: DataFrame) -> DataFrame:
    """Metadata rows as they are kept: a named track goes by its service id alone."""
    return rows.withColumn("track_id", F.when(F.col("source_id").isNull(), F.col("track_id")))
