"""Real-input path: export files + landed metadata + landed weather -> warehouse -> queries."""

import json
import os
import uuid

from encore.operators.manifests import track_batches
from encore.plans.catalog import QUERIES
from encore.session import path_join, shared_dir
from encore.sources.warehouse import build_warehouse, sources_from_landed
from tests.rows import FIELDS, play


def _json(path, obj):
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(obj, fh)


def test_landed_inputs_end_to_end(spark, tmp_path):
    export = os.path.join(tmp_path, "export")
    os.makedirs(export)
    plays = [play(f"2024-0{m}-1{d}T1{d}:00:00Z", 150000 + d * 1000, f"Song{d % 3}", f"Band{d % 2}",
                  f"x:track:{d % 3}", country="DE" if d % 2 else "PK", skipped=d == 4)
             for m in (1, 7) for d in range(6)]
    _json(os.path.join(export, "Streaming_History_Audio_2024.json"), [dict(zip(FIELDS, r)) for r in plays])

    # first build without service data, to get the request manifest (as the original flow does)
    base = path_join(shared_dir(spark), "landed-" + uuid.uuid4().hex[:8])
    first = build_warehouse(spark, sources_from_landed(spark, export, None, None), base + "/a")
    batch = track_batches(first.dim_tracks).first()
    ids = [int(i) for i in range(batch.first_track_id, batch.last_track_id + 1)]
    assert first.track_metadata.where("api_available").count() == 0

    meta_dir = os.path.join(tmp_path, "meta")
    os.makedirs(meta_dir)
    tracks = [{"popularity": 40 + i, "duration_ms": 200000, "explicit": False,
               "album": {"release_date": "2001-02"}} if i else None for i in range(len(ids))]
    _json(os.path.join(meta_dir, "batch_0.json"), {"track_ids": ids, "tracks": tracks})
    wx_dir = os.path.join(tmp_path, "weather")
    os.makedirs(wx_dir)
    for country, city in [("DE", "Berlin"), ("PK", "Karachi")]:
        days = [f"2024-0{m}-1{d}" for m in (1, 7) for d in range(6)]
        _json(os.path.join(wx_dir, f"{country}.json"), {"country": country, "city": city, "daily": {
            "time": days, "temperature_2m_max": [20.0] * 12, "temperature_2m_min": [10.0] * 12,
            "temperature_2m_mean": [15.0 if c == "DE" else 30.0 for c in [country] * 12],
            "precipitation_sum": [2.0, 0.0] * 6, "sunshine_duration": [7200.0] * 12,
            "wind_speed_10m_max": [5.0] * 12}})

    wh = build_warehouse(spark, sources_from_landed(spark, export, meta_dir, wx_dir), base + "/b")
    meta = {r.track_id: r for r in wh.track_metadata.collect()}
    assert sum(r.api_available for r in meta.values()) == len(ids) - 1
    assert {r.release_year for r in meta.values() if r.api_available} == {2001}
    w = wh.weather.collect()
    assert len(w) == wh.plays.select("country", "date").distinct().count()
    assert {r.temp_category for r in w} == {"warm", "hot"} and all(r.sunshine_hrs == 2.0 for r in w)
    for key, fn in QUERIES.items():
        if key not in ("removed_rows",):
            fn(wh).collect()
    assert QUERIES["removed_rows"](wh).first().raw_rows == len(plays)


def test_command_line_build_and_query(spark, tmp_path, capsys):
    from encore.__main__ import main
    export = os.path.join(tmp_path, "export")
    os.makedirs(export)
    rows = [play(f"2024-03-0{d}T10:00:00Z", 90000, f"S{d % 2}", "B", f"x:track:{d % 2}") for d in range(1, 6)]
    _json(os.path.join(export, "Streaming_History_Audio_2024.json"), [dict(zip(FIELDS, r)) for r in rows])
    out = path_join(shared_dir(spark), "cli-" + uuid.uuid4().hex[:8])
    assert main(["build", "--export", export, "--out", out]) == 0
    assert main(["query", "top_artists", "year_comparison", "--warehouse", out]) == 0
    printed = capsys.readouterr().out
    assert "artist_name" in printed and "|B " in printed and "-- year_comparison" in printed
    assert main(["sql", "SELECT count(*) AS n FROM fact_streams", "--warehouse", out]) == 0
    assert "|5 " in capsys.readouterr().out
