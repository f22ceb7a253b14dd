"""Clean step: raw export rows -> one row per real music play.

Order of the rules (each a column expression, one shuffle overall for the
exact-duplicate removal, which a first build shares with the total order):

  rename -> keep music rows (track and artist present) -> drop unused fields
  -> parse / coerce / default / normalise -> ms_played >= 5000
  -> exact duplicates removed -> derived columns.

Deduplicating on the normalised base columns is the same as deduplicating on
all clean columns, since every derived column is a function of them.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from encore.functions import calendar, text
from encore.functions.numeric import half_even
from encore.sources.raw import DROP_COLUMNS, RENAMES

# Shortest play kept, in milliseconds.
MIN_MS_PLAYED = 5000

BASE_COLUMNS = [
    "played_at", "ms_played", "platform", "country", "track_name", "artist_name",
    "album_name", "track_uri", "reason_start", "reason_end",
    "shuffle", "skipped", "offline", "incognito_mode",
]
DERIVED_COLUMNS = [
    "platform_group", "minutes_played", "date", "year", "month", "month_name",
    "week", "day_of_week", "hour", "is_weekend", "track_id",
]
CLEAN_COLUMNS = BASE_COLUMNS + DERIVED_COLUMNS
FLAGS = ["shuffle", "skipped", "offline", "incognito_mode"]

# Total order of clean plays (rows are distinct on these after the clean step);
# fixes chronological stream ids with deterministic tie-breaks.
PLAY_ORDER = [
    "played_at", "track_uri", "ms_played", "track_name", "artist_name", "album_name",
    "platform", "country", "reason_start", "reason_end",
    "shuffle", "skipped", "offline", "incognito_mode",
]


def renamed(raw: DataFrame) -> DataFrame:
    mapping = {k: v for k, v in RENAMES.items() if k in raw.columns and k != v}
    df = raw.withColumnsRenamed(mapping) if mapping else raw
    missing = [c for c in RENAMES.values() if c not in df.columns]
    for c in missing:
        df = df.withColumn(c, F.lit(None).cast("boolean" if c in FLAGS else "string"))
    return df


def music_rows(raw: DataFrame) -> DataFrame:
    df = renamed(raw)
    return df.filter(F.col("track_name").isNotNull() & F.col("artist_name").isNotNull()) \
             .drop(*DROP_COLUMNS)


def coerce_ms(col: Column, dtype_name: str) -> Column:
    """Numeric text/number -> whole milliseconds; unparsable, NaN or infinite -> 0."""
    if dtype_name in ("bigint", "int", "smallint", "tinyint"):
        return F.coalesce(col.cast("long"), F.lit(0).cast("long"))
    if dtype_name == "string":  # Java's own suffixes (60000d, 60000f) are no numbers
        col = F.when(col.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), col)
    d = col.try_cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0).cast("long")).otherwise(d.try_cast("long"))


def coerce_flag(col: Column, dtype_name: str) -> Column:
    """A flag of any JSON type -> boolean: NULL, false, 0 and empty text are false,
    any other value is true."""
    if dtype_name == "boolean":
        return F.coalesce(col, F.lit(False))
    whole = col.cast("string")
    text = F.lower(F.trim(whole))
    no = text.isin("", "false") | F.coalesce(text.try_cast("double") == 0.0, F.lit(False))
    return F.when(whole.isNull() | (whole == "false"), F.lit(False)).when(whole == "true", F.lit(True)).otherwise(~no)


def typed_rows(raw: DataFrame) -> DataFrame:
    df = music_rows(raw)
    dtypes = dict(df.dtypes)
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        calendar.utc_wall_clock(F.col("played_at"), fields["played_at"]).alias("played_at"),
        coerce_ms(F.col("ms_played"), dtypes["ms_played"]).alias("ms_played"),
        text.normalise_platform(F.col("platform")).alias("platform"),
        text.normalise_country(F.col("country")).alias("country"),
        "track_name", "artist_name", "album_name", "track_uri", "reason_start", "reason_end",
        *[coerce_flag(F.col(c), dtypes[c]).alias(c) for c in FLAGS],
    )


def minutes(ms: Column) -> Column:
    return half_even(ms / F.lit(60000.0), 2)


def with_derived(base: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    ts = F.col("played_at")
    cols = {
        "platform_group": text.platform_group(F.col("platform")),
        "minutes_played": minutes(F.col("ms_played")),
        **calendar.calendar_columns(ts),
        "track_id": text.last_uri_segment(F.col("track_uri")),
    }
    return base.select(*BASE_COLUMNS, *[v.alias(k) for k, v in cols.items()], *keep)


COPIES = "_copies"


def long_rows(raw: DataFrame) -> DataFrame:
    return typed_rows(raw).filter(F.col("ms_played") >= MIN_MS_PLAYED)


def clean_plays(raw: DataFrame) -> DataFrame:
    """E1: the clean play table (lazy)."""
    return with_derived(long_rows(raw).dropDuplicates(BASE_COLUMNS))


def raw_counts(raw: DataFrame) -> DataFrame:
    """One row: the raw rows and the music rows among them."""
    is_music = F.col("track_name").isNotNull() & F.col("artist_name").isNotNull()
    return renamed(raw).agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(is_music).alias("music_rows"))


def deduplicated(rows: DataFrame) -> DataFrame:
    """One clean play per distinct long row, with its copies in ``COPIES``."""
    return with_derived(rows.groupBy(*BASE_COLUMNS).agg(F.count(F.lit(1)).alias(COPIES)), [COPIES])


class CountedClean:
    """The clean plays with their counts taken on the way, so that the raw rows are
    read once: ``rows``, the long rows, and ``plays``, made of them, observe raw, music
    and long rows; ``plays`` has each play's copies in ``COPIES``.

    Spark adds up observed values over finished tasks, so a stage that runs again after a
    lost executor counts twice. What was written doesn't: observed counts hold if the
    long rows are the written rows or the sum of their copies, else ``counts`` counts anew."""

    def __init__(self, raw: DataFrame):
        self.raw, self.observed = raw, Observation()
        is_music = F.col("track_name").isNotNull() & F.col("artist_name").isNotNull()
        is_long = coerce_ms(F.col("ms_played"), dict(renamed(raw).dtypes)["ms_played"]) >= MIN_MS_PLAYED
        watched = renamed(raw).observe(
            self.observed, F.count(F.lit(1)).alias("raw_rows"), F.count_if(is_music).alias("music_rows"),
            F.count_if(is_music & is_long).alias("long_rows"))
        self.rows = long_rows(watched)
        self.plays = deduplicated(self.rows)

    def counts(self, written: DataFrame) -> DataFrame:
        """The row of ``raw_counts``; ``written``: the plays or rows as written (an action ran)."""
        copies = written.agg(F.coalesce(F.sum(COPIES if COPIES in written.columns else F.lit(1)), F.lit(0))).first()[0]
        try:
            seen = self.observed.get
        except Py4JJavaError:  # Spark cut the observed part out of the plan of an empty table
            seen = None
        if seen is None or seen["long_rows"] != copies:
            return raw_counts(self.raw)
        return written.sparkSession.range(1).select(
            *[F.lit(seen[c]).cast("long").alias(c) for c in ("raw_rows", "music_rows")])


def removed_rows(counts: DataFrame, clean: DataFrame) -> DataFrame:
    """E2: rows removed by the junk filters, counted after the music filter.

    ``removed_from_raw`` also counts the non-music rows (raw minus clean).
    ``counts`` is the row that the build stored (``raw_counts``).
    """
    clean_rows = clean.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        "raw_rows", "music_rows", clean_rows.alias("clean_rows"),
        (F.col("music_rows") - clean_rows).alias("removed_rows"),
        (F.col("raw_rows") - clean_rows).alias("removed_from_raw"),
    )
