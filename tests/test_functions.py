"""Column functions: labels, rounding, dense keys, first-per-key, landed JSON."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions import labels, numeric
from encore.functions.numeric import half_even, mean_half_even, sql_round
from encore.operators.keys import dense_ids, first_per_key
from encore.sources.landed import metadata_rows, read_metadata_json, read_weather_json, weather_rows


def test_weather_labels(spark):
    df = spark.createDataFrame([(4.9, 1.0, 12), (5.0, 1.1, 3), (15.0, None, 6), (25.0, 0.0, 9),
                                (None, 2.0, 2)], "t double, p double, m int")
    out = df.select(labels.temp_category(F.col("t")).alias("c"),
                    labels.temp_category(F.col("t"), strict=True).alias("s"),
                    labels.is_rainy(F.col("p")).alias("r"),
                    labels.season(F.col("m")).alias("z")).collect()
    assert [(r.c, r.s, r.r, r.z) for r in out] == [
        ("cold", "cold", False, "Winter"), ("cool", "cool", True, "Spring"),
        ("warm", "warm", False, "Summer"), ("hot", "hot", False, "Autumn"),
        ("hot", "unknown", True, "Winter")]


def test_release_year_and_period(spark):
    df = spark.createDataFrame([("1999",), ("1999-05",), ("1999-05-01",), (None,), ("",), ("abc",)], "d string")
    assert [r[0] for r in df.select(labels.release_year(F.col("d"))).collect()] == \
        [1999, 1999, 1999, None, None, None]
    p = spark.createDataFrame([(2024, 3)], "y int, m int").select(labels.period_label(F.col("y"), F.col("m")))
    assert p.first()[0] == "2024-03"


def test_rounding_rules(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (2.675,), (0.575,)], "x double")
    out = df.select(sql_round(F.col("x"), 2).alias("a"), half_even(F.col("x"), 2).alias("b")).collect()
    # SQL ROUND: half away from zero on x*100 as a double; pandas: rint on x*100
    assert [(r.a, r.b) for r in out] == [(1.0, 1.0), (0.13, 0.12), (2.68, 2.68), (0.57, 0.57)]


def test_mean_half_even_is_exact(spark):
    df = spark.createDataFrame([("a", 1.23), ("a", 1.24), ("b", 0.1), ("b", 0.1), ("b", 0.1), ("b", 0.2),
                                ("c", None)], "k string, v double")
    out = {r.k: r.m for r in df.groupBy("k").agg(mean_half_even(F.col("v"), 2, 2).alias("m")).collect()}
    assert out == {"a": 1.24, "b": 0.12, "c": None}  # 1.235 -> 1.24, 0.125 -> 0.12


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_ids_equal_row_number(spark, scratch, parts):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 613).alias("a"), (F.col("id") % 11).alias("b"),
                                     F.col("id"))
    got = dense_ids(df, ["a", "b", "id"], "rid", scratch, num_partitions=parts)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b", "id")))
    assert got.count() == 5000
    assert got.select("id", "rid").exceptAll(want.select("id", F.col("rid").cast("long"))).count() == 0


def test_first_per_key_nulls_last(spark):
    df = spark.createDataFrame([("u1", "B", "x", "A1"), ("u1", "A", None, "A2"), ("u1", "A", "y", "A3"),
                                ("u2", "C", None, "A1")], "k string, name string, album string, artist string")
    out = {r.k: (r.name, r.album, r.artist)
           for r in first_per_key(df, "k", ["name"], ["album", "artist"]).collect()}
    assert out == {"u1": ("A", "y", "A3"), "u2": ("C", None, "A1")}


def test_weather_payload_rows(spark, tmp_path):
    payload = {"country": "DE", "city": "Berlin", "daily": {
        "time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [5.0, None],
        "temperature_2m_min": [1.0, 0.0], "temperature_2m_mean": [3.0, None],
        "precipitation_sum": [1.1, None], "sunshine_duration": [3600.0, None],
        "wind_speed_10m_max": [10.0, 12.0]}}
    path = os.path.join(tmp_path, "w.json")
    with open(path, "w") as fh:
        json.dump(payload, fh)
    rows = weather_rows(read_weather_json(spark, path)).orderBy("date").collect()
    assert len(rows) == 2
    assert (rows[0].temp_mean, rows[0].precipitation, rows[0].sunshine_duration, rows[0].city) == \
        (3.0, 1.1, 3600.0, "Berlin")
    assert (rows[1].temp_mean, rows[1].wind_speed_max) == (None, 12.0)


def test_empty_weather_payload_fails(spark, tmp_path):
    path = os.path.join(tmp_path, "w.json")
    with open(path, "w") as fh:
        json.dump({"country": "PK", "city": "Karachi", "daily": {"time": []}}, fh)
    with pytest.raises(Exception, match="no daily data"):
        weather_rows(read_weather_json(spark, path)).collect()


def test_metadata_payload_rows(spark, tmp_path):
    payload = {"track_ids": [1, 2, 3], "tracks": [
        {"popularity": 50, "duration_ms": 200000, "explicit": False, "album": {"release_date": "1999-05"}},
        None,
        {"popularity": 10, "duration_ms": 100000, "explicit": True, "album": {"release_date": "2001"}}]}
    path = os.path.join(tmp_path, "m.json")
    with open(path, "w") as fh:
        json.dump(payload, fh)
    rows = {r.track_id: r for r in metadata_rows(read_metadata_json(spark, path)).collect()}
    assert rows[1].release_year == 1999 and rows[1].api_available is True
    assert rows[2].api_available is False and rows[2].popularity is None
    assert rows[3].release_year == 2001


def test_decimal_round_is_pythons_round(spark):
    import random
    rnd = random.Random(7)
    values = ([s / 3600 for s in range(0, 86401)] + [k / 8 for k in range(-200, 200)]
              + [rnd.uniform(-1000, 1000) for _ in range(20000)] + [round(rnd.uniform(0, 90), 3) for _ in range(20000)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = df.select("v", numeric.decimal_round(F.col("v"), 2).alias("r")).collect()
    assert [r.v for r in got if r.v is not None and r.r != round(r.v, 2)] == []
    assert [r.r for r in got if r.v is None] == [None]


def test_completion_is_rounded_in_double(spark):
    from encore.operators.features import track_features
    plays = spark.createDataFrame([(1, "2024-01-01", 61750, 1.03, False, False), (2, "2024-01-01", 5000, 0.08, False, False)],
                                  "track_id long, date string, ms_played long, minutes_played double, skipped boolean, shuffle boolean")
    api = spark.createDataFrame([(1, 500000), (2, 0)], "track_id long, duration_ms long")
    rows = {r.track_id: r for r in track_features(plays, api).collect()}
    assert rows[1].completion_rate == 0.124 and rows[1].completion_rate_strict == 0.124
    assert rows[2].completion_rate == 1.0 and rows[2].completion_rate_strict is None
