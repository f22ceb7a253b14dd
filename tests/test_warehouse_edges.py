"""A hand-written warehouse: star, metadata, weather and query edge cases."""

import datetime as dt

import pytest

from encore.plans import listening, previews
from encore.plans.catalog import QUERIES
from encore.sources.warehouse import Sources, build_warehouse
from tests.rows import play, raw_df

DAY1, DAY2, DAY3 = "2024-01-10", "2024-07-11", "2024-04-12"


def _plays():
    rows = []
    ts = lambda d, i: f"{d}T{i % 24:02d}:{i // 24:02d}:00Z"
    # gem: 3 plays at 90% of 200 s
    rows += [play(ts(DAY1, i), 180000, "Alpha", "Art1", "x:track:1") for i in range(3)]
    # two URIs, same name and artist, equal completion -> one merged row in top tracks
    rows += [play(ts(DAY1, 10 + i), 100000, "Same", "Art2", "x:track:2") for i in range(3)]
    rows += [play(ts(DAY2, 10 + i), 100000, "Same", "Art2", "x:track:3") for i in range(3)]
    # one URI under two names -> the smaller name wins
    rows += [play(ts(DAY2, 20), 60000, "Bname", "Art1", "x:track:4"),
             play(ts(DAY2, 21), 60000, "Aname", "Art1", "x:track:4")]
    # no duration / zero duration / plays longer than the track
    rows += [play(ts(DAY3, i), 90000, "NoDur", "Art3", "x:track:5", country="PK") for i in range(5)]
    rows += [play(ts(DAY3, 10 + i), 90000, "ZeroDur", "Art3", "x:track:6", country="PK") for i in range(5)]
    rows += [play(ts(DAY3, 20 + i), 120000, "Long", "Art3", "x:track:7", country="PK") for i in range(5)]
    # service returned null for this one
    rows += [play(ts(DAY1, 30), 60000, "Gone", "Art1", "x:track:8")]
    # 15 and 16 plays at 90% completion, never skipped: gem and not a gem
    rows += [play(ts(DAY2, 30 + i), 90000, "Fifteen", "Art4", "x:track:9") for i in range(15)]
    rows += [play(ts(DAY2, 60 + i), 90000, "Sixteen", "Art4", "x:track:10") for i in range(16)]
    # a play without URI: kept in clean, not in the fact (check V1 reports it)
    rows += [play(ts(DAY1, 40), 60000, "NoUri", "Art1", None)]
    # a play in a country without coordinates
    rows += [play(ts(DAY1, 41), 60000, "Usonly", "Art1", "x:track:11", country="US", skipped=True)]
    return rows


@pytest.fixture(scope="module")
def wh(spark):
    from encore.session import path_join, shared_dir
    import uuid
    meta = spark.createDataFrame([
        ("x:track:1", 70, 200000, False, "1999", True),
        ("x:track:2", 10, 100000, False, "1999-05", True),
        ("x:track:3", 10, 100000, False, None, True),
        ("x:track:4", 5, 60000, True, "2001-02-03", True),
        ("x:track:5", 1, None, False, "2000", True),
        ("x:track:6", 1, 0, False, "2000", True),
        ("x:track:7", 1, 60000, False, "2000", True),
        ("x:track:8", None, None, None, None, False),
        ("x:track:9", 3, 100000, False, "2010", True),
        ("x:track:10", 3, 100000, False, "2010", True),
    ], "track_uri string, popularity int, duration_ms bigint, explicit boolean, release_date string, "
       "api_available boolean")
    wx = spark.createDataFrame([
        (dt.date(2024, 1, 10), 6.9, -1.1, 2.9, 1.0, 3600.0, 5.0, "DE", "Berlin"),
        (dt.date(2024, 7, 11), 28.0, 20.0, 24.0, 1.1, 36000.0, 5.0, "DE", "Berlin"),
        (dt.date(2024, 1, 11), 5.0, 1.0, 3.0, 9.0, 0.0, 5.0, "DE", "Berlin"),     # no plays that day
        (dt.date(2024, 4, 12), None, None, None, None, None, 5.0, "PK", "Karachi"),
        (dt.date(2024, 1, 10), 30.0, 20.0, 25.0, 0.0, 0.0, 5.0, "PK", "Karachi"),  # no PK plays that day
    ], "date date, temp_max double, temp_min double, temp_mean double, precipitation double, "
       "sunshine_duration double, wind_speed_max double, country string, city string")
    sources = Sources(raw=raw_df(spark, _plays()), metadata=meta, weather=wx)
    return build_warehouse(spark, sources, path_join(shared_dir(spark), "edge-" + uuid.uuid4().hex[:8]))


def _by_name(df, key="track_name"):
    return {r[key]: r for r in df.collect()}


def test_star_ids_and_first_name(wh):
    assert [r.artist_name for r in wh.dim_artists.orderBy("artist_id").collect()] == \
        ["Art1", "Art2", "Art3", "Art4"]
    t = {r.track_uri: r for r in wh.dim_tracks.collect()}
    assert t["x:track:4"].track_name == "Aname"
    ids = [r.track_id for r in wh.dim_tracks.orderBy("track_name", "track_uri").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_stream_ids_chronological_and_v1(wh):
    s = wh.staged.orderBy("row_id").collect()
    assert [r.row_id for r in s] == list(range(1, len(s) + 1))
    assert [r.played_at for r in s] == sorted(r.played_at for r in s)
    checks = {r.check: r.violations for r in QUERIES["integrity_checks"](wh).collect()}
    assert checks == {"fact_rows_equal_clean_rows": 1, "orphan_track_ids": 0, "orphan_artist_ids": 0,
                      "null_stream_ids": 0, "duplicate_track_uris": 0}
    assert wh.dim_date().count() == wh.plays.count() + 1


def test_completion_rules(wh):
    m = {r.track_id: r for r in wh.track_metadata.collect()}
    names = {r.track_uri: r.track_id for r in wh.dim_tracks.collect()}
    get = lambda uri: m[names[uri]]
    assert get("x:track:1").completion_rate == 0.9
    assert get("x:track:5").completion_rate == 1.0 and get("x:track:5").completion_rate_strict is None
    assert get("x:track:6").completion_rate == 1.0 and get("x:track:6").completion_rate_strict is None
    assert get("x:track:7").completion_rate == 1.0
    assert get("x:track:8").api_available is False and get("x:track:8").popularity is None
    assert (get("x:track:1").release_year, get("x:track:2").release_year, get("x:track:3").release_year) == \
        (1999, 1999, None)


def test_hidden_gems_bounds(wh):
    gems = _by_name(listening.hidden_gems(wh))
    assert set(gems) == {"Alpha", "Same", "NoDur", "ZeroDur", "Long", "Fifteen"}  # not 16 plays
    assert gems["Alpha"].total_plays == 3


def test_top_tracks_merges_same_name(wh):
    top = _by_name(listening.top_tracks(wh))
    assert top["Same"].total_plays == 6
    leaders = _by_name(listening.completion_leaders(wh))
    strict = _by_name(listening.completion_leaders(wh, strict=True))
    assert "NoDur" in leaders and "NoDur" not in strict


def test_weather_semi_join_and_labels(wh):
    w = {(r.country, r.date): r for r in wh.weather.collect()}
    assert set(w) == {("DE", dt.date(2024, 1, 10)), ("DE", dt.date(2024, 7, 11)), ("PK", dt.date(2024, 4, 12))}
    de1 = w[("DE", dt.date(2024, 1, 10))]
    assert (de1.is_rainy, de1.temp_category, de1.season, de1.sunshine_hrs) == (False, "cold", "Winter", 1.0)
    de2 = w[("DE", dt.date(2024, 7, 11))]
    assert (de2.is_rainy, de2.temp_category, de2.season, de2.sunshine_hrs) == (True, "warm", "Summer", 10.0)
    pk = w[("PK", dt.date(2024, 4, 12))]
    assert (pk.is_rainy, pk.temp_category, pk.temp_category_strict) == (False, "hot", "unknown")


def test_play_weighted_weather(wh):
    rows = {(r.country, r.season, r.temp_category): r for r in listening.weather_listening(wh).collect()}
    de = rows[("DE", "Winter", "cold")]
    # Jan 10 in DE: Alpha x3, Same x3, Gone, NoUri has no fact row
    assert (de.total_days, de.rainy_days, de.avg_streams_per_day) == (1, 0, 7.0)
    summer = rows[("DE", "Summer", "warm")]
    assert summer.rainy_days == summer.avg_streams_per_day  # every play that day was rainy
    assert rows[("PK", "Spring", "hot")].avg_temp_c is None


def test_request_ranges_skip_countries_without_city(wh):
    r = {x.country: x for x in QUERIES["weather_request_ranges"](wh).collect()}
    assert set(r) == {"DE", "PK"}
    assert (r["DE"].start_date, r["DE"].end_date, r["DE"].active_days) == ("2024-01-10", "2024-07-11", 2)


def test_batches_cover_every_track(wh):
    b = QUERIES["track_request_batches"](wh).collect()
    assert len(b) == 1 and b[0].n_tracks == wh.dim_tracks.count()


def test_previews_and_reshapes_run(wh):
    assert previews.popular_tracks(wh).first().track_name == "Alpha"
    grid = QUERIES["heatmap_grid"](wh).collect()
    assert [r.day_of_week for r in grid] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                           "Saturday", "Sunday"]
    total = sum(v or 0 for r in grid for k, v in r.asDict().items() if k.startswith("h"))
    assert total == wh.plays.count()
    diff = QUERIES["country_differences"](wh).first()
    assert diff.de_unique_artists - diff.pk_unique_artists == diff.artists_gap


def test_every_query_runs(wh):
    for key, fn in QUERIES.items():
        fn(wh).collect()
