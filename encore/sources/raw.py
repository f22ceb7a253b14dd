"""Raw play-export reader (JSON arrays of play objects).

Every field is read as text and coerced by the clean step, so one odd value (a
flag written as 1) never fails the read of all files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from encore.session import conf_int, file_system
from encore.sources import ranges

# Export field -> clean column name.
RENAMES = {
    "ts": "played_at",
    "ms_played": "ms_played",
    "platform": "platform",
    "conn_country": "country",
    "ip_addr": "ip_addr",
    "master_metadata_track_name": "track_name",
    "master_metadata_album_artist_name": "artist_name",
    "master_metadata_album_album_name": "album_name",
    "spotify_track_uri": "track_uri",
    "reason_start": "reason_start",
    "reason_end": "reason_end",
    "shuffle": "shuffle",
    "skipped": "skipped",
    "offline": "offline",
    "incognito_mode": "incognito_mode",
}

# Fields removed after the music filter (ip_addr for privacy).
DROP_COLUMNS = [
    "episode_name", "episode_show_name", "spotify_episode_uri",
    "audiobook_title", "audiobook_uri",
    "audiobook_chapter_uri", "audiobook_chapter_title",
    "offline_timestamp", "ip_addr",
]

EXPORT_GLOB = "Streaming_History_Audio_*.json"

_S = T.StringType()
RAW_SCHEMA = T.StructType([
    T.StructField("ts", _S),
    T.StructField("platform", _S),
    T.StructField("ms_played", _S),  # coerced by the clean step
    T.StructField("conn_country", _S),
    T.StructField("ip_addr", _S),
    T.StructField("master_metadata_track_name", _S),
    T.StructField("master_metadata_album_artist_name", _S),
    T.StructField("master_metadata_album_album_name", _S),
    T.StructField("spotify_track_uri", _S),
    T.StructField("episode_name", _S),
    T.StructField("episode_show_name", _S),
    T.StructField("spotify_episode_uri", _S),
    T.StructField("audiobook_title", _S),
    T.StructField("audiobook_uri", _S),
    T.StructField("audiobook_chapter_uri", _S),
    T.StructField("audiobook_chapter_title", _S),
    T.StructField("reason_start", _S),
    T.StructField("reason_end", _S),
    T.StructField("shuffle", _S),
    T.StructField("skipped", _S),
    T.StructField("offline", _S),
    T.StructField("offline_timestamp", _S),
    T.StructField("incognito_mode", _S),
])


# Files over this size are read by several tasks, smaller ones whole by one.
SPLIT_BYTES_KEY = "encore.export.splitBytes"
SPLIT_BYTES_DEFAULT = 64 * 1024 * 1024


def read_export(spark: SparkSession, directory: str, pattern: str = EXPORT_GLOB) -> DataFrame:
    """All export files in ``directory`` as one DataFrame.

    A glob that matches nothing raises, as a missing export should, and so does
    a file that isn't a whole JSON array of objects: its plays must not go
    missing in silence. Large files are cut into byte ranges
    (``sources.ranges``); both ways give the same rows (an object in a text field,
    which no play has, keeps its own spacing there).
    """
    path = directory.rstrip("/") + "/" + pattern
    fs, glob = file_system(spark, path)
    files = [(f.getPath().toString(), f.getLen()) for f in fs.globStatus(glob) or []]
    if not files:
        raise FileNotFoundError(f"no export files {path}")
    if empty := [f for f, size in files if size == 0]:
        raise ValueError(f"malformed: empty export files {empty}")
    limit = conf_int(spark, SPLIT_BYTES_KEY, SPLIT_BYTES_DEFAULT)
    large = sorted(f for f, size in files if size > limit)
    small = sorted(f for f, size in files if size <= limit)
    parts = []
    if small:
        parts.append(spark.read.schema(RAW_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(small))
    if large:
        parts.append(ranges.read_records(spark, large, RAW_SCHEMA))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
