"""S1/S2: export files found by pattern, read with the fixed schema, cleaned."""

import json
import os

import pytest

from encore.operators.clean import clean_plays
from encore.sources.raw import read_export
from tests.rows import FIELDS, play


def _write(folder, name, rows, extra=None):
    objs = [dict(zip(FIELDS, r)) for r in rows]
    for o in objs:
        o["ms_played"] = int(o["ms_played"]) if o["ms_played"] else o["ms_played"]
        o.update(extra or {})
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        json.dump(objs, fh)


def test_reads_matching_files_only(spark, tmp_path):
    _write(tmp_path, "Streaming_History_Audio_2023.json",
           [play("2023-05-01T08:00:00Z", 60000, "Song", "Band", "x:track:1")],
           extra={"username": "someone", "episode_name": None})
    _write(tmp_path, "Streaming_History_Audio_2024_1.json",
           [play("2024-05-01T08:00:00Z", 70000, "Song", "Band", "x:track:1"),
            play("2024-05-01T09:00:00Z", 70000, None, None, None)])
    _write(tmp_path, "Streaming_History_Video_2024.json",
           [play("2024-06-01T08:00:00Z", 70000, "Clip", "Band", "x:track:9")])
    raw = read_export(spark, str(tmp_path))
    assert raw.count() == 3
    clean = clean_plays(raw).orderBy("played_at").collect()
    assert [(r.year, r.ms_played, r.minutes_played) for r in clean] == [(2023, 60000, 1.0), (2024, 70000, 1.17)]


def test_missing_export_fails(spark, tmp_path):
    with pytest.raises(Exception):
        read_export(spark, str(tmp_path)).count()
