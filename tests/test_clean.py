"""Clean step edge rows (FIXTURES part C)."""

import datetime as dt

from pyspark.sql import functions as F

from encore.operators.clean import CLEAN_COLUMNS, clean_plays, raw_counts, removed_rows
from tests.rows import play, raw_df

TS = "2024-03-05T10:00:00Z"


def _clean(spark, rows):
    return clean_plays(raw_df(spark, rows))


def test_music_filter_and_threshold(spark):
    rows = [
        play(TS, 60000, None, "A", "x:track:1"),            # no track name
        play(TS, 60000, "T", None, "x:track:1"),            # no artist
        play(TS, 4999, "T", "A", "x:track:1"),              # accidental tap
        play("2024-03-05T10:01:00Z", 5000, "T", "A", "x:track:1"),
        play("2024-03-05T10:02:00Z", "abc", "T", "A", "x:track:1"),  # unparsable -> 0
        play("2024-03-05T10:03:00Z", None, "T", "A", "x:track:1"),   # missing -> 0
    ]
    out = _clean(spark, rows).collect()
    assert [r.ms_played for r in out] == [5000]
    raw = raw_df(spark, rows)
    r = removed_rows(raw_counts(raw), clean_plays(raw)).first()
    assert (r.raw_rows, r.music_rows, r.clean_rows, r.removed_rows, r.removed_from_raw) == (6, 4, 1, 3, 5)


def test_minutes_half_even_on_binary(spark):
    out = _clean(spark, [play(TS, 34500, "T", "A", "x:track:1")]).first()
    assert out.minutes_played == 0.57  # 0.575 is stored below the tie


def test_duplicates_removed_after_dropping_ip(spark):
    rows = [play(TS, 60000, "T", "A", "x:track:1", ip="1.1.1.1"),
            play(TS, 60000, "T", "A", "x:track:1", ip="1.1.1.1"),
            play(TS, 60000, "T", "A", "x:track:1", ip="2.2.2.2"),
            play(TS, 60000, "T", "A", "x:track:1", ip="2.2.2.2", country=" de ")]
    assert _clean(spark, rows).count() == 1


def test_text_normalisation(spark):
    rows = [play("2024-03-05T10:00:00Z", 60000, "T", "A", "x:track:1", platform=" ANDROID ", country=" de "),
            play("2024-03-05T10:01:00Z", 60000, "T", "A", "x:track:1", platform="Android OS 11", country=None),
            play("2024-03-05T10:02:00Z", 60000, "T", "A", "x:track:1", platform=None, country="　pk\t"),
            play("2024-03-05T10:03:00Z", 60000, "T", "A", "x:track:1", platform="web_player"),
            play("2024-03-05T10:04:00Z", 60000, "T", "A", "x:track:1", platform="partner")]
    out = _clean(spark, rows).orderBy("played_at").collect()
    assert [(r.platform, r.platform_group, r.country) for r in out] == [
        ("android", "mobile", "DE"), ("android os 11", "other", "UNKNOWN"),
        ("unknown", "other", "PK"), ("web_player", "web", "DE"), ("partner", "other", "DE")]


def test_calendar_columns_utc(spark):
    rows = [play("2024-12-30T23:30:00Z", 60000, "T", "A", "x:track:1"),
            play("2024-03-09T12:00:00Z", 60000, "T", "A", "x:track:1"),   # Saturday
            play("2024-03-08T12:00:00Z", 60000, "T", "A", "x:track:1")]   # Friday
    out = {r.date: r for r in _clean(spark, rows).collect()}
    r = out[dt.date(2024, 12, 30)]
    assert (r.year, r.week, r.hour, r.month, r.month_name, r.day_of_week, r.is_weekend) == \
        (2024, 1, 23, 12, "Dec", "Monday", False)
    assert out[dt.date(2024, 3, 9)].is_weekend is True
    assert out[dt.date(2024, 3, 8)].is_weekend is False


def test_calendar_independent_of_session_zone(spark):
    rows = [play("2024-12-30T23:30:00Z", 60000, "T", "A", "x:track:1")]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        r = _clean(spark, rows).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.hour, r.date) == (23, dt.date(2024, 12, 30))


def test_flags_default_false_and_uri_segment(spark):
    r = _clean(spark, [play(TS, 60000, "T", "A", "x:track:AbC")]).first()
    assert (r.shuffle, r.skipped, r.offline, r.incognito_mode) == (False, False, False, False)
    assert r.track_id == "AbC"
    r = _clean(spark, [play(TS, 60000, "T", "A", None)]).first()
    assert r.track_id is None


def test_clean_schema(spark):
    df = _clean(spark, [play(TS, 60000, "T", "A", "x:track:1")])
    assert df.columns == CLEAN_COLUMNS
    assert dict(df.dtypes)["played_at"] == "timestamp_ntz"
    assert df.where(F.col("ms_played") >= 5000).count() == 1
