"""Hand-written raw export rows for edge tests."""

from encore.sources.raw import RAW_SCHEMA

FIELDS = [f.name for f in RAW_SCHEMA.fields]


def play(ts, ms, track, artist, uri, platform="android", country="DE", album="Album",
         skipped=None, shuffle=None, offline=None, incognito=None, ip="10.0.0.1",
         reason_start="trackdone", reason_end="trackdone"):
    row = dict.fromkeys(FIELDS)
    row.update({
        "ts": ts, "ms_played": None if ms is None else str(ms), "platform": platform,
        "conn_country": country, "ip_addr": ip,
        "master_metadata_track_name": track, "master_metadata_album_artist_name": artist,
        "master_metadata_album_album_name": album, "spotify_track_uri": uri,
        "reason_start": reason_start, "reason_end": reason_end,
        "shuffle": shuffle, "skipped": skipped, "offline": offline, "incognito_mode": incognito,
    })
    return tuple(row[f] for f in FIELDS)


def raw_df(spark, rows):
    # every export field is read as text
    texts = [tuple(str(v).lower() if isinstance(v, bool) else v for v in r) for r in rows]
    return spark.createDataFrame(texts, RAW_SCHEMA)
