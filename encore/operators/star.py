"""Star schema: artist and track dimensions with dense ids, and the play fact.

The calendar columns stay on the fact (``plays``) instead of a one-row-per-play
date dimension joined back 1:1; ``dim_date`` is a projection of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import calendar
from encore.operators.clean import minutes
from encore.operators.keys import PART, first_per_key, registered_ids

FACT_COLUMNS = [
    "stream_id", "date_id", "track_id", "artist_id", "played_at", "ms_played",
    "minutes_played", "skipped", "shuffle", "offline", "incognito_mode",
    "reason_start", "reason_end", "country", "platform_group",
]
DATE_COLUMNS = ["played_at", "date", "year", "month", "month_name", "week",
                "day_of_week", "hour", "is_weekend"]
PLAY_COLUMNS = FACT_COLUMNS + [c for c in DATE_COLUMNS if c != "played_at"]
# What the others of a play follow from.
BARE_COLUMNS = [c for c in FACT_COLUMNS if c not in ("date_id", "minutes_played")]

# A (URI, artist) pair with more than this share of all plays is hot. At most
# 1 / share pairs can be, which bounds the only forced broadcast.
HOT_SHARE = 0.001


def dim_artists(clean: DataFrame, scratch: str, known: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    names = clean.select("artist_name").where(F.col("artist_name").isNotNull()).distinct()
    return registered_ids(names, ["artist_name"], ["artist_name"], "artist_id", scratch, known, parts).select(
        "artist_id", "artist_name")


def dim_tracks(clean: DataFrame, artists: DataFrame, scratch: str, known: DataFrame | None = None,
               parts: int | None = None) -> DataFrame:
    """One row per URI (smallest track name, then album, then artist), its
    artist's id, and a dense id in (track_name, track_uri) order."""
    firsts = first_per_key(clean.where(F.col("track_uri").isNotNull()), "track_uri",
                           ["track_name"], ["album_name", "artist_name"])
    with_artist = firsts.join(artists, "artist_name")
    ided = registered_ids(with_artist.select("track_uri", "track_name", "album_name", "artist_id"), ["track_uri"],
                          ["track_name", "track_uri"], "track_id", scratch, known, parts)
    return ided.select("track_id", "track_uri", "track_name", "album_name", "artist_id")


def names(rows: DataFrame) -> DataFrame:
    """The distinct names of tracks, albums and artists, and in ``n`` their rows."""
    return rows.groupBy("track_uri", "track_name", "album_name", "artist_name").agg(F.count(F.lit(1)).alias("n"))


def play_ids(clean: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Ids and number of plays of each distinct (track_uri, artist_name): the
    dimensions are joined with the pairs (counted map-side), not with the plays.
    ``clean``: plays, or their ``names``."""
    pairs = clean.groupBy("track_uri", "artist_name").agg(F.sum("n" if "n" in clean.columns else F.lit(1)).alias("n"))
    return (pairs.join(tracks.select("track_uri", "track_id"), "track_uri")
                 .join(artists.select("artist_name", "artist_id"), "artist_name"))


def plays(staged: DataFrame, ids: DataFrame) -> DataFrame:
    """The fact with its calendar columns (and ``PART``, if ``staged`` has it)."""
    return with_calendar(bare_plays(staged, ids))


def with_calendar(bare: DataFrame) -> DataFrame:
    """``bare_plays`` with the columns that follow from theirs."""
    made = bare.withColumns({"date_id": F.col("stream_id"), "minutes_played": minutes(F.col("ms_played")),
                             **calendar.calendar_columns(F.col("played_at"))})
    return made.select(*PLAY_COLUMNS, *[c for c in bare.columns if c == PART])


def bare_plays(staged: DataFrame, ids: DataFrame) -> DataFrame:
    """The fact without what follows from its other columns, as it is shuffled (and
    ``PART``, if ``staged`` has it). Inner joins: a play without a URI (or with an unknown
    one) has no track and is left out, which check V1 reports.

    One pass over the plays. Those of hot pairs take their ids from a broadcast of at
    most 1,000 rows. The others meet the pairs in one join, whose kind Spark picks from
    the written table's size; if that is a shuffle, a play that has its ids already
    goes by its own row id, which meets nothing, so no hot pair fills a task."""
    total = ids.agg(F.sum("n")).scalar()
    is_hot = F.col("n") > total * F.lit(HOT_SHARE)
    pair = [F.col("track_uri").alias("_uri"), F.col("artist_name").alias("_name")]
    hot = ids.where(is_hot).select(*pair, F.struct("track_id", "artist_id").alias("_hot"))
    # 0 in a form that isn't a constant: a constant is no join key
    rest = ids.where(~is_hot).select(*pair, F.when(F.col("n") < 0, 1).otherwise(0).cast("long").alias("_own"),
                                     F.struct("track_id", "artist_id").alias("_cold"))
    rows = staged.select("row_id", *BARE_COLUMNS[3:], "track_uri", "artist_name", *[c for c in staged.columns if c == PART])
    same = lambda a, b: [a["track_uri"] == b["_uri"], a["artist_name"] == b["_name"]]
    names = rows.columns
    marked = rows.join(F.broadcast(hot), same(rows, hot), "left").select(*names, "_hot")
    marked = marked.withColumn("_own", F.when(F.col("_hot").isNotNull(), F.col("row_id")).otherwise(0).cast("long"))
    met = marked.join(rest, [*same(marked, rest), marked["_own"] == rest["_own"]], "left")
    found = F.coalesce("_hot", "_cold")
    return (met.where(found.isNotNull()).withColumn("_ids", found)
            .select(F.col("row_id").alias("stream_id"), F.col("_ids.track_id").alias("track_id"),
                    F.col("_ids.artist_id").alias("artist_id"), *BARE_COLUMNS[3:], *[c for c in names if c == PART]))
