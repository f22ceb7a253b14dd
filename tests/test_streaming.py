"""Incremental ingest over landed export files (availableNow triggers)."""

import json
import os
import uuid

from encore.session import path_join, shared_dir
from encore.streaming import ingest
from tests.rows import FIELDS, play


def _land(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        json.dump([dict(zip(FIELDS, r)) for r in rows], fh)


def test_incremental_clean_and_daily(spark, tmp_path):
    landing = os.path.join(tmp_path, "landing")
    os.makedirs(landing)
    base = path_join(shared_dir(spark), "stream-" + uuid.uuid4().hex[:8])
    out, ckpt = base + "/out", base + "/ckpt"
    first = [play("2024-01-01T10:00:00Z", 60000, "T", "A", "x:track:1"),
             play("2024-01-01T10:00:00Z", 60000, "T", "A", "x:track:1"),      # exact copy
             play("2024-01-01T11:00:00Z", 3000, "T", "A", "x:track:1"),       # too short
             play("2024-01-01T12:00:00Z", 90000, None, "A", "x:track:2")]     # not music
    _land(landing, "Streaming_History_Audio_2024_0.json", first)
    for q in ingest.start(spark, landing, out, ckpt):
        q.awaitTermination()
    assert spark.read.parquet(out + "/streaming_clean").count() == 1

    later = [play("2024-01-01T10:00:00Z", 60000, "T", "A", "x:track:1"),      # copy in a later file
             play("2024-01-05T09:00:00Z", 120000, "U", "B", "x:track:3", skipped=True)]
    _land(landing, "Streaming_History_Audio_2024_1.json", later)
    _land(landing, "notes.json", later)  # not an export file
    for q in ingest.start(spark, landing, out, ckpt):
        q.awaitTermination()
    clean = spark.read.parquet(out + "/streaming_clean")
    assert clean.count() == 2
    assert set(clean.columns) >= {"played_at", "minutes_played", "platform_group", "track_id"}
    daily = {(r.date.isoformat(), r.country): r for r in spark.read.parquet(out + "/daily_activity").collect()}
    assert daily[("2024-01-01", "DE")].plays == 1  # closed by the watermark after Jan 5 arrived
