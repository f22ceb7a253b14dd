"""Rebuilds, newest landed rows, files read by ranges, observed counts, roll-up."""

import datetime as dt
import json
import os
import random
import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from encore.operators import clean as clean_op
from encore.operators import keys, rollup
from encore.operators import weather as weather_op
from encore.plans import listening
from encore.plans.catalog import QUERIES
from encore.session import path_join, shared_dir
from encore.sources import landed, ranges, raw
from encore.sources import warehouse as W
from tests.rows import FIELDS, play, raw_df


def _base(spark, name):
    return path_join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def _land(folder, name, rows, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump([dict(zip(FIELDS, r)) for r in rows] if isinstance(rows, list) and rows and isinstance(rows[0], tuple) else rows, fh, ensure_ascii=False)
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


def _year(year, names):
    return [play(f"{year}-0{1 + i % 9}-11T{i % 24:02d}:00:00Z", 60000 + i, n, f"Band {n[0]}", f"x:track:{n}", country="DE" if i % 2 else "PK",
                 skipped=i % 3 == 0) for i, n in enumerate(names)]


# Keys ------------------------------------------------------------------------


def test_known_ids_outlast_rebuilds(spark, tmp_path):
    export, base = str(tmp_path / "export"), _base(spark, "keys")
    _land(export, "Streaming_History_Audio_2023.json", _year(2023, ["m", "p", "z", "m"]))
    sources = lambda: W.sources_from_landed(spark, export, None, None)
    first = W.rebuild(spark, sources(), base)

    def ids(wh):
        return ({r.artist_name: r.artist_id for r in wh.dim_artists.collect()}, {r.track_uri: r.track_id for r in wh.dim_tracks.collect()},
                {(str(r.played_at), r.track_uri, r.ms_played): r.row_id for r in wh.staged.collect()})

    a = ids(first)
    assert [sorted(x.values()) for x in a] == [[1, 2, 3], [1, 2, 3], [1, 2, 3, 4]]
    # keys that sort before, between and after, and older plays
    _land(export, "Streaming_History_Audio_2021.json", _year(2021, ["a", "n", "zz", "m", "a"]))
    b = ids(W.rebuild(spark, sources(), base))
    for old, new in zip(a, b):
        assert old.items() <= new.items() and sorted(new.values()) == list(range(1, len(new) + 1))
    assert [b[1][f"x:track:{n}"] for n in ("a", "n", "zz")] == [4, 5, 6]
    # a key that goes and comes back has its id again; others aren't given it meanwhile
    os.remove(os.path.join(export, "Streaming_History_Audio_2021.json"))
    _land(export, "Streaming_History_Audio_2020.json", _year(2020, ["b"]))
    c = ids(W.rebuild(spark, sources(), base))
    assert c[1] == {**a[1], "x:track:b": 7} and max(c[2].values()) == 10
    _land(export, "Streaming_History_Audio_2021.json", _year(2021, ["a", "n", "zz", "m", "a"]))
    wh = W.rebuild(spark, sources(), base)
    d = ids(wh)
    assert d[1] == {**b[1], "x:track:b": 7} and len(set(d[2].values())) == len(d[2]) == 10
    assert all(r.violations == 0 for r in QUERIES["integrity_checks"](wh).collect())
    again = W.open_latest(spark, base)
    assert ids(again) == d and again.plays.exceptAll(wh.plays).count() == 0
    assert QUERIES["summary_stats"](again).first().total_streams == 10
    times = [r.played_at for r in again.plays.orderBy("played_at").collect()]
    assert times == sorted(times) and len(times) == 10


def test_an_appended_file_rewrites_its_years_only(spark, tmp_path):
    export, new, whole = (str(tmp_path / x) for x in ("export", "new", "whole"))
    base, other = _base(spark, "append"), _base(spark, "whole")
    meta = str(tmp_path / "meta")
    _answers(meta, "1.json", [90, 50], time.time() - 100)
    sources = lambda folder, meta=meta: W.sources_from_landed(spark, folder, meta, None)
    old = _year(2021, ["m", "p", "q"]) + _year(2022, ["m", "z", "z"]) + _year(2023, ["a", "m"])
    # another name of a known track, a known play again, new tracks, and a year of its own
    added = _year(2022, ["b", "z"]) + old[3:5] + _year(2024, ["m", "c"]) + [
        play("2022-05-05T05:05:05Z", 70000, "A new name", "Band z", "x:track:z"), play("2022-05-05T05:05:05Z", 70, "short", "x", "x:track:s"),
        play("2022-05-05T05:05:05Z", 70000, None, None, None)]
    _land(export, "Streaming_History_Audio_1.json", old)
    _land(new, "Streaming_History_Audio_2.json", added)
    for name, rows in (("Streaming_History_Audio_1.json", old), ("Streaming_History_Audio_2.json", added)):
        _land(whole, name, rows)
    first = W.rebuild(spark, sources(export), base)
    W.rebuild(spark, sources(export), other)
    reader = W.load_warehouse(spark, first.root)
    wh = W.rebuild(spark, sources(new, None), base, append=True)
    want = W.rebuild(spark, sources(whole), other)
    for table in ("clean", "staged", "plays", "dim_artists", "dim_tracks", "track_metadata", "activity", "track_years", "artist_keys", "track_keys"):
        a, b = getattr(wh, table), getattr(want, table)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0, table
    for key in ("summary_stats", "year_comparison", "country_summary", "removed_rows", "top_tracks", "dim_date"):
        assert sorted(map(str, QUERIES[key](wh).collect())) == sorted(map(str, QUERIES[key](want).collect())), key
    for name in ("streaming_clean", "plays"):
        assert {d for d in os.listdir(path_join(wh.root, name)) if d.startswith("year")} == {"year=2022", "year=2024"}
    assert reader.plays.count() == 8  # who reads the version before still can
    # removal spares the files that a kept version reads
    _land(new, "Streaming_History_Audio_2.json", _year(2025, ["m"]))
    last = W.rebuild(spark, sources(new, None), base, keep=1, append=True)
    assert len([d for d in os.listdir(base)]) == 3 and len(W.versions(spark, base)) == 3
    again = W.open_latest(spark, base)
    assert again.plays.count() == want.plays.count() + 1 and again.plays.exceptAll(last.plays).count() == 0
    p = again.plays.where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    # every folder is asked for that year only
    assert len(re.findall(r"PartitionFilters: \[[^\]]*year[^\]]*2021", p)) == p.count("FileScan parquet") > 0
    name = "encore_" + uuid.uuid4().hex[:8]
    again.register_tables(name)
    assert spark.newSession().table(f"{name}.fact_plays").count() == again.plays.count()
    # one more full rebuild needs no older folder
    W.rebuild(spark, sources(whole), base, keep=1)
    assert len(os.listdir(base)) == 1


def test_registered_ids_with_null_keys_and_ties(spark, scratch):
    df = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    one = keys.registered_ids(df("b", None, "a"), ["k"], ["k"], "id", scratch + "/1", None)
    assert {r.k: r.id for r in one.collect()} == {"a": 1, "b": 2, None: 3}
    two = keys.registered_ids(df("0", None, "a", "c"), ["k"], ["k"], "id", scratch + "/2", one)
    assert {r.k: r.id for r in two.collect()} == {"a": 1, None: 3, "0": 4, "c": 5}
    kept = keys.registry(one, two, ["k"], "id")
    assert {r.k: r.id for r in kept.collect()} == {"a": 1, "b": 2, None: 3, "0": 4, "c": 5}


def test_old_versions_are_removed(spark, tmp_path):
    export, base = str(tmp_path / "export"), _base(spark, "kept")
    _land(export, "Streaming_History_Audio_0.json", _year(2023, ["m", "p"]))
    os.makedirs(path_join(base, "000000000000001-broken"))
    built = [os.path.basename(W.rebuild(spark, W.sources_from_landed(spark, export, None, None), base, keep=2).root) for _ in range(3)]
    assert sorted(os.listdir(base)) == built[1:]
    assert [os.path.basename(v) for v in W.versions(spark, base)] == built[:0:-1]


# Landed rows -----------------------------------------------------------------


def _answers(folder, name, popularity, mtime):
    tracks = [None if p is None else {"popularity": p, "duration_ms": 100000, "explicit": False, "album": {"release_date": "2001"}}
              for p in popularity]
    _land(folder, name, [{"source_ids": ["m", "p"], "tracks": tracks}], mtime)


def test_the_newest_answer_counts(spark, tmp_path):
    now = time.time()
    export, meta, base = str(tmp_path / "export"), str(tmp_path / "meta"), _base(spark, "answers")
    _land(export, "Streaming_History_Audio_0.json", _year(2023, ["m", "p"]))
    _answers(meta, "1.json", [90, 50], now - 100)
    _answers(meta, "0.json", [40, None], now - 50)

    def found():
        wh = W.rebuild(spark, W.sources_from_landed(spark, export, meta, None), base)
        return {r.track_name: r.popularity for r in wh.track_metadata.join(wh.dim_tracks, "track_id").collect()}

    assert found() == {"m": 40, "p": 50}
    # an older file that lands late changes nothing; what was landed needn't stay
    for name in os.listdir(meta):
        os.remove(os.path.join(meta, name))
    _answers(meta, "2.json", [70, 70], now - 200)
    assert found() == {"m": 40, "p": 50}
    _answers(meta, "3.json", [5, 6], now)
    assert found() == {"m": 5, "p": 6}


def test_the_newest_weather_day_counts(spark, tmp_path):
    now, folder = time.time(), str(tmp_path / "weather")
    for name, degrees, at in (("a.json", 30.0, now - 100), ("b.json", 10.0, now), ("c.json", 20.0, now - 50)):
        _land(folder, name, {"country": "DE", "city": "Berlin", "daily": {
            "time": ["2024-01-01"], "temperature_2m_max": [degrees], "temperature_2m_min": [1.0], "temperature_2m_mean": [degrees],
            "precipitation_sum": [None], "sunshine_duration": [18.0], "wind_speed_10m_max": [4.0]}}, at)
    rows = landed.weather_rows(landed.read_weather_json(spark, folder))
    assert [(r.date, r.temp_mean) for r in weather_op.one_per_day(rows).collect()] == [(dt.date(2024, 1, 1), 10.0)]
    older = rows.where("temp_mean = 30.0")
    newer = rows.where("temp_mean = 20.0")
    for stored, fresh in ((older, newer), (newer, older)):
        assert [r.temp_mean for r in landed.merged(stored, fresh, landed.WEATHER_KEYS).collect()] == [20.0]


# Export files ----------------------------------------------------------------


def test_odd_flags_fail_no_read(spark, tmp_path):
    base = dict(zip(FIELDS, play("2024-01-01T10:00:00Z", 60000, "T", "A", "x:track:1")))
    values = [True, False, 1, 0, None, "true", "false", "", 0.0, 2.5, "yes"]
    _land(str(tmp_path), "Streaming_History_Audio_0.json",
          [{**base, "skipped": v, "offline_timestamp": v, "ms_played": 60000 + i} for i, v in enumerate(values)])
    got = clean_op.clean_plays(raw.read_export(spark, str(tmp_path))).orderBy("ms_played").collect()
    assert [r.skipped for r in got] == [True, False, True, False, False, True, False, False, False, True, True]


@pytest.fixture()
def small_ranges(spark):
    """Files of some kB are cut into many ranges."""
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", raw.SPLIT_BYTES_KEY: "0"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NASTY = ["plain", 'quo"te', "back\\slash", 'end\\"', "br{ace", "br}ace", "}{", '"}', "\\}", '\\"}', "[1, 2]", "], [", "é日🙂", " ", "tab\t\n", "}" * 40, '"' * 7]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("names", [["plain", "other"], NASTY])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges, indent, names):
    rng = random.Random(3)
    objects = []
    for i in range(120):
        o = dict(zip(FIELDS, play("2024-01-01T10:00:00Z", 60000 + i, rng.choice(names), rng.choice(names), f"x:track:{i}")))
        o = {k: v for k, v in o.items() if v is not None}
        if names is NASTY and i % 7 == 0:
            o["more"] = {"deep": {"er": [{"x": "}"}, {}, []]}, "s": rng.choice(names)}
        objects.append(o)
    path = str(tmp_path / "Streaming_History_Audio_ 1.json")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(objects, fh, ensure_ascii=False, indent=indent)
    _land(str(tmp_path), "Streaming_History_Audio_2.json", [])
    found = raw.read_export(spark, str(tmp_path))
    whole = spark.read.schema(raw.RAW_SCHEMA).option("multiLine", True).json(path)
    assert ranges._fragments(spark, [path]).rdd.getNumPartitions() > 10
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(found) == order(whole) and found.count() == 120


@pytest.mark.parametrize("names", [["plain"], NASTY])
@pytest.mark.parametrize("breaks", [lambda t: t[:-40], lambda t: t[:-1], lambda t: t[1:], lambda t: t.replace("}, {", "} {", 1), lambda t: t + "x",
                                    lambda t: t + t, lambda t: t.replace('"ts"', "ts", 1), lambda t: "", lambda t: t[:t.index('"ts"') + 2],
                                    lambda t: t.replace("}, {", "}], [{", 1)])
def test_broken_large_files_fail(spark, tmp_path, small_ranges, names, breaks):
    objects = [dict(zip(FIELDS, play("2024-01-01T10:00:00Z", 60000 + i, names[i % len(names)], "A", f"x:track:{i}"))) for i in range(20)]
    with open(tmp_path / "Streaming_History_Audio_1.json", "w", encoding="utf-8") as fh:
        fh.write(breaks(json.dumps(objects)))
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_export(spark, str(tmp_path)).collect()


# Counts on the way -----------------------------------------------------------


def _counted_rows():
    rows = _year(2023, ["m", "p", "z"]) * 2 + [play("2024-01-01T10:00:00Z", 4000, "T", "A", "x:track:1"),
                                               play("2024-01-01T10:00:00Z", 60000, None, "A", None)]
    return rows, (8, 7)


def test_counts_are_observed_while_cleaning(spark, scratch):
    rows, want = _counted_rows()
    counted = clean_op.CountedClean(raw_df(spark, rows))
    ranged = keys.write_ranged(counted.plays, clean_op.PLAY_ORDER, scratch, 3, ["year"])
    assert ranged.count() == 3 and sorted(r[clean_op.COPIES] for r in ranged.collect()) == [2, 2, 2]
    found = counted.counts(ranged)
    assert (found.first().raw_rows, found.first().music_rows) == want
    assert "LocalTableScan" not in found._jdf.queryExecution().executedPlan().toString()  # the raw rows aren't read


def test_counts_hold_when_a_stage_ran_again(spark, scratch):
    """Observed values that count some rows twice don't match the written copies."""
    rows, want = _counted_rows()
    counted = clean_op.CountedClean(raw_df(spark, rows))
    ranged = keys.write_ranged(counted.plays, clean_op.PLAY_ORDER, scratch, 3)

    class Twice:
        get = {k: v + 3 for k, v in counted.observed.get.items()}

    counted.observed = Twice
    found = counted.counts(ranged).first()
    assert (found.raw_rows, found.music_rows) == want


def test_the_build_reads_the_raw_rows_once(spark, tmp_path, monkeypatch):
    export = str(tmp_path / "export")
    _land(export, "Streaming_History_Audio_0.json", _year(2023, ["m", "p"]))
    monkeypatch.setattr(clean_op, "raw_counts", lambda raw: pytest.fail("read again"))
    wh = W.build_warehouse(spark, W.sources_from_landed(spark, export, None, None), _base(spark, "once"))
    assert QUERIES["removed_rows"](wh).first().raw_rows == 2


# Roll-up, bitmaps, catalogue -------------------------------------------------


def test_roll_up_adds_up_to_the_plays(wh_small):
    plays, act = wh_small.plays, wh_small.activity
    total = lambda df, n, minutes: df.agg(n, minutes).first()
    dec = F.sum(F.col("minutes_played").cast("decimal(18,2)"))
    assert tuple(total(plays, F.count(F.lit(1)), dec)) == tuple(total(act, F.sum("n"), F.sum("minutes")))
    assert act.groupBy("date", "hour", "country").count().where("count > 1").count() == 0


def test_bitmaps_count_exactly_and_sketches_nearly(spark, wh_small):
    ids = spark.range(200_000).select(F.lit(2024).alias("year"), F.when(F.col("id") % 3 == 0, "DE").otherwise("PK").alias("country"),
                                      (F.col("id") % 70_000 + 1).alias("track_id"), (F.col("id") % 11 + 1).alias("artist_id"))
    groups = rollup.id_groups(ids)
    for by in ([], ["country"], ["year", "country"]):
        want = ids.groupBy(*by).agg(F.countDistinct("artist_id").alias("unique_artists"), F.countDistinct("track_id").alias("unique_tracks"))
        got = rollup.distinct_ids(rollup.id_bitmaps(groups), *by)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        near = rollup.estimated_ids(rollup.id_sketches(groups), *by).collect()
        for a, b in zip(sorted(near), sorted(want.collect())):
            assert abs(a.unique_tracks - b.unique_tracks) <= 0.05 * b.unique_tracks and a.unique_artists == b.unique_artists
    exact = {r.year: r.unique_tracks for r in listening.year_comparison(wh_small).collect()}
    near = {r.year: r.unique_tracks for r in listening.year_comparison(wh_small, approximate=True).collect()}
    assert exact.keys() == near.keys() and all(abs(near[y] - n) <= 0.05 * n for y, n in exact.items())
    one = listening.summary_stats(wh_small, approximate=True).first()
    assert abs(one.unique_tracks - wh_small.dim_tracks.count()) <= 0.05 * one.unique_tracks


def test_the_fact_is_shuffled_at_most_by_its_place(spark, wh_small):
    from encore.operators import star
    plays = star.plays(wh_small.staged.withColumn(keys.PART, F.lit(0)), star.play_ids(wh_small.clean, wh_small.dim_tracks, wh_small.dim_artists))
    p = plays.repartitionById(4, F.col(keys.PART))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in p
    files = re.findall(r"FileScan parquet \[played_at[^\n]*", p)
    assert len(files) == 1  # one pass over the plays


def test_catalogue_tables_for_other_sessions(spark, wh_small):
    name = "encore_" + uuid.uuid4().hex[:8]
    wh_small.register_tables(name)
    other = spark.newSession()
    assert other.table(f"{name}.fact_plays").count() == wh_small.plays.count()
    got = other.sql(f"SELECT artist_name, count(*) n FROM {name}.fact_plays JOIN {name}.dim_artists USING (artist_id) GROUP BY 1").collect()
    assert sum(r.n for r in got) == wh_small.plays.count()
    about = {r.col_name: r.data_type for r in other.sql(f"DESCRIBE EXTENDED {name}.dim_tracks").collect()}
    assert f"{wh_small.dim_tracks.count()} rows" in about["Statistics"] and about["Type"] == "EXTERNAL"
    columns = {r.info_name: r.info_value for r in other.sql(f"DESCRIBE EXTENDED {name}.dim_tracks track_id").collect()}
    assert columns["distinct_count"] != "NULL"
    spark.sql(f"DROP DATABASE {name} CASCADE")
    assert wh_small.plays.count() > 0
