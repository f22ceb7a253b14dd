"""Broken, repeated, late and shifted inputs: nothing is lost, doubled or misplaced in silence."""

import datetime as dt
import json
import os
import uuid

import pytest

from encore.operators import clean as clean_op
from encore.operators import weather as weather_op
from encore.session import path_join, shared_dir
from encore.sources import landed, raw
from encore.plans.catalog import QUERIES
from encore.sources.warehouse import build_warehouse, complete, completed_build, open_latest, rebuild, sources_from_landed
from encore.streaming import ingest
from tests.rows import FIELDS, play, raw_df


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        json.dump([dict(zip(FIELDS, r)) for r in rows], fh)


def _plays(n, year="2024", track="T"):
    return [play(f"{year}-01-{i + 1:02d}T10:00:00Z", 60000 + i, track, "A", "x:track:1") for i in range(n)]


def test_a_cut_off_export_file_fails(spark, tmp_path):
    folder = str(tmp_path)
    _land(folder, "Streaming_History_Audio_0.json", _plays(10))
    text = open(os.path.join(folder, "Streaming_History_Audio_0.json")).read()
    with open(os.path.join(folder, "Streaming_History_Audio_1.json"), "w") as fh:
        fh.write(text[:-40])
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        raw.read_export(spark, folder).collect()


def test_an_older_file_that_lands_later_is_taken(spark, tmp_path):
    landing = os.path.join(tmp_path, "landing")
    base = path_join(shared_dir(spark), "late-" + uuid.uuid4().hex[:8])
    for year in ("2024", "2023"):
        _land(landing, f"Streaming_History_Audio_{year}.json", _plays(10, year) + _plays(1, "2024"))
        for q in ingest.start(spark, landing, base + "/out", base + "/ckpt"):
            q.awaitTermination()
    assert spark.read.parquet(base + "/out/streaming_clean").count() == 20
    daily = spark.read.parquet(base + "/out/daily_activity").collect()
    assert len(daily) == 20 and all(r.plays == 1 for r in daily)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    texts = {"2024-10-27T00:30:00Z": (27, 0, 30), "2024-10-27T01:30:00Z": (27, 1, 30), "2024-03-31T01:30:00Z": (31, 1, 30),
             "2024-03-31 02:30:00": (31, 2, 30), "2024-10-27T02:45:00+02:00": (27, 0, 45), "2024-06-01 23:30:00": (1, 23, 30),
             " 2024-01-06T10:00:00Z ": (6, 10, 0), "2024-01-07T1:00:00Z": (7, 1, 0),
             "2024-10-26T20:15:00.5-0500": (27, 1, 15), "2024-06-02": (2, 0, 0)}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = clean_op.clean_plays(raw_df(spark, [play(t, 60000, t, "A", "x:track:1") for t in texts])).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.track_name: (r.played_at.day, r.played_at.hour, r.played_at.minute) for r in got} == texts


def test_text_that_is_no_time_fails(spark):
    with pytest.raises(Exception, match="not a timestamp"):
        clean_op.clean_plays(raw_df(spark, [play("yesterday: noon", 60000, "T", "A", "x:track:1")])).collect()


def test_only_plain_numbers_are_milliseconds(spark):
    values = {"60000": 60000, "6e4": 60000, " 7000.9 ": 7000, "60000d": None, "60000f": None, "0x9999": None, "many": None}
    got = clean_op.clean_plays(raw_df(spark, [play("2024-01-01T00:00:00Z", v, v, "A", "x:track:1") for v in values])).collect()
    assert {r.track_name: r.ms_played for r in got} == {k: v for k, v in values.items() if v}


def _metadata(folder, name, source_ids, popularity):
    os.makedirs(folder, exist_ok=True)
    tracks = [None if p is None else {"popularity": p, "duration_ms": 100000, "explicit": False, "album": {"release_date": "2001"}}
              for p in popularity]
    with open(os.path.join(folder, name), "w") as fh:
        json.dump([{"track_ids": list(range(1, len(source_ids) + 1)), "source_ids": source_ids, "tracks": tracks}], fh)


def test_metadata_landed_twice_and_ids_that_shift(spark, tmp_path):
    export, meta = os.path.join(tmp_path, "export"), os.path.join(tmp_path, "meta")
    rows = [play(f"2024-01-0{d}T10:00:00Z", 60000, n, "A", f"x:track:{n}") for n in ("Mmm", "Zzz") for d in range(1, 6)]
    _land(export, "Streaming_History_Audio_0.json", rows)
    _metadata(meta, "0.json", ["Mmm", "Zzz"], [11, 99])
    _metadata(meta, "1.json", ["Zzz", "Mmm"], [None, 11])
    # a track that sorts first shifts every id of the rebuild
    _land(export, "Streaming_History_Audio_1.json", [play("2024-01-01T10:00:00Z", 60000, "Aaa", "A", "x:track:Aaa")])
    root = path_join(shared_dir(spark), "meta-" + uuid.uuid4().hex[:8])
    wh = build_warehouse(spark, sources_from_landed(spark, export, meta, None), root)
    got = {r.track_name: (r.popularity, r.total_plays) for r in wh.track_metadata.join(wh.dim_tracks, "track_id").collect()}
    assert got == {"Aaa": (None, 1), "Mmm": (11, 5), "Zzz": (99, 5)}
    assert wh.track_metadata.count() == 3
    complete(wh)
    assert set(wh.register_views("t_")) >= {"t_fact_streams", "t_dim_tracks", "t_dim_track_metadata"}
    assert spark.sql("SELECT count(*) n FROM t_fact_streams JOIN t_dim_tracks USING (track_id)").first().n == 11


def test_a_weather_day_landed_twice_is_one_day(spark):
    day = {"time": ["2024-01-01"], "temperature_2m_max": [5.0], "temperature_2m_min": [1.0], "temperature_2m_mean": [3.0],
           "precipitation_sum": [0.0], "sunshine_duration": [18.0], "wind_speed_10m_max": [4.0]}
    payloads = spark.createDataFrame([("DE", "Berlin", day), ("DE", "Berlin", {**day, "temperature_2m_mean": [None]})],
                                     landed.WEATHER_SCHEMA)
    rows = weather_op.one_per_day(landed.weather_rows(payloads)).collect()
    assert [(r.country, r.date, r.temp_mean) for r in rows] == [("DE", dt.date(2024, 1, 1), 3.0)]


def test_a_failed_rebuild_leaves_the_warehouse_before(spark, tmp_path):
    export = os.path.join(tmp_path, "export")
    _land(export, "Streaming_History_Audio_0.json", _plays(2))
    base = path_join(shared_dir(spark), "gate-" + uuid.uuid4().hex[:8])
    first = rebuild(spark, sources_from_landed(spark, export, None, None), base)
    assert completed_build(spark, base).endswith(os.path.basename(first.root))
    assert not os.path.exists(path_join(first.root, "_scratch"))
    # a play without a URI never reaches the fact: the build must not be published
    _land(export, "Streaming_History_Audio_1.json", [play("2024-02-01T10:00:00Z", 60000, "T", "A", None)])
    with pytest.raises(ValueError, match="fact_rows_equal_clean_rows: 1"):
        rebuild(spark, sources_from_landed(spark, export, None, None), base)
    assert len([d for d in os.listdir(base) if not d.startswith("_")]) == 2
    wh = open_latest(spark, base)  # needs no inputs, and names its tables
    assert os.path.basename(wh.root) == os.path.basename(first.root)
    by_sql = spark.sql("""SELECT artist_name, count(*) AS n FROM fact_streams JOIN dim_artists USING (artist_id)
                          GROUP BY artist_name""").collect()
    assert {r.artist_name: r.n for r in by_sql} == {r.artist_name: r.total_streams for r in QUERIES["top_artists"](wh).collect()}


def test_an_export_without_plays_builds_and_opens(spark, tmp_path):
    export = os.path.join(tmp_path, "export")
    _land(export, "Streaming_History_Audio_0.json", [])
    base = path_join(shared_dir(spark), "none-" + uuid.uuid4().hex[:8])
    rebuild(spark, sources_from_landed(spark, export, None, None), base)
    wh = open_latest(spark, base)
    assert wh.plays.count() == 0 and QUERIES["summary_stats"](wh).first().total_streams == 0
    for fn in QUERIES.values():
        fn(wh).collect()
