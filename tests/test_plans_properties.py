"""Plan shape (pushdown, pruning, partial top-k, pre-aggregation) and
result properties (totals agree, ranks dense, ids stable under re-partitioning)."""

import os
import re

import pytest

from encore.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_filter_is_partial_top_k(wh_small):
    p = plan(QUERIES["country_top_artists"](wh_small))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    p = plan(QUERIES["country_peak_hours"](wh_small))
    assert "WindowGroupLimit" in p


def test_weather_join_sees_preaggregated_fact(wh_small):
    p = plan(QUERIES["weather_listening"](wh_small))
    join = p.index("BroadcastHashJoin")
    assert "HashAggregate(keys=[country" in p[join:]  # fact grouped by (country, date) below the join


def test_scans_prune_columns_and_push_filters(wh_small):
    p = plan(QUERIES["skip_analysis"](wh_small))
    assert re.search(r"PushedFilters: \[[^\]]*In\(country, \[DE,PK\]\)", p)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["top_artists"](wh_small)))
    fact_scan = [s for s in scans if "minutes_played" in s][0]
    assert set(c.split(":")[0] for c in fact_scan.split(",")) == {"track_id", "artist_id", "minutes_played", "skipped"}


def test_top_k_uses_take_ordered(wh_small):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_artists"](wh_small))


def test_totals_agree(wh_small):
    total = wh_small.plays.count()
    by_year = sum(r.total_streams for r in QUERIES["year_comparison"](wh_small).collect())
    by_country = sum(r.streams for r in QUERIES["preview_by_country"](wh_small).collect())
    heat = sum(r.stream_count for r in QUERIES["hourly_heatmap"](wh_small).collect())
    summary = QUERIES["summary_stats"](wh_small).first().total_streams
    assert total == by_year == by_country == heat == summary


def test_checks_clean_and_ranks_dense(wh_small):
    assert all(r.violations == 0 for r in QUERIES["integrity_checks"](wh_small).collect())
    for key, rank in [("country_top_artists", "country_rank"), ("country_peak_hours", "hour_rank")]:
        rows = QUERIES[key](wh_small).collect()
        by_country = {}
        for r in rows:
            by_country.setdefault(r.country, []).append(r[rank])
        for ranks in by_country.values():
            assert sorted(ranks) == list(range(1, len(ranks) + 1))


@pytest.fixture(scope="module")
def wh_other_partitions(spark):
    """Same tables, built with a different shuffle partition count."""
    import uuid
    from encore.session import path_join, shared_dir
    from encore.sources.warehouse import build_warehouse, sources_from_tables
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        root = path_join(shared_dir(spark), "alt-" + uuid.uuid4().hex[:8])
        yield build_warehouse(spark, sources_from_tables(spark, SF_SMALL), root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ids_stable_under_repartitioning(wh_small, wh_other_partitions):
    for get in [lambda w: w.dim_artists, lambda w: w.dim_tracks, lambda w: w.fact_streams(),
                lambda w: w.track_metadata, lambda w: w.weather]:
        a, b = get(wh_small), get(wh_other_partitions)
        assert a.count() == b.count()
        assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_flagship_query_stable(wh_small, wh_other_partitions):
    a = QUERIES["top_tracks"](wh_small).collect()
    b = QUERIES["top_tracks"](wh_other_partitions).collect()
    assert a == b


def test_features_equal_on_any_partitioning_and_join(spark, wh_small):
    from encore.operators import features
    api = wh_small.track_metadata.select("track_id", "duration_ms")
    want = sorted(map(tuple, features.track_features(wh_small.plays, api).collect()))
    for parts, threshold in ((1, "-1"), (7, "10m"), (64, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            again = features.track_features(wh_small.plays.repartition(parts), api)
            assert sorted(map(tuple, again.collect())) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("threshold", ["-1", "100m"])
@pytest.mark.parametrize("share", [0.0, 0.001, 1.0])
def test_fact_is_the_same_on_any_join(spark, wh_small, monkeypatch, threshold, share):
    """All, some or no pairs hot; broadcast or sorted: the same fact."""
    from encore.operators import star
    monkeypatch.setattr(star, "HOT_SHARE", share)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        ids = star.play_ids(wh_small.clean, wh_small.dim_tracks, wh_small.dim_artists)
        rebuilt = star.plays(wh_small.staged, ids)
        if threshold == "-1":
            assert "SortMergeJoin" in plan(rebuilt)
        cols = wh_small.plays.columns
        assert rebuilt.count() == wh_small.plays.count()
        assert rebuilt.select(*cols).exceptAll(wh_small.plays).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_files_are_in_time_order_and_pruned_by_year(spark, wh_small):
    from pyspark.sql import functions as F
    files = (wh_small.plays.groupBy(F.input_file_name().alias("f"))
             .agg(F.min("stream_id").alias("a"), F.max("stream_id").alias("b")).orderBy("a").collect())
    assert len(files) > 1 and all(x.b < y.a for x, y in zip(files, files[1:]))
    assert all("/year=" in r.f for r in files)
    p = plan(wh_small.plays.where("year = 1995").select("track_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1995", p)


@pytest.mark.parametrize("key", ["summary_stats", "year_comparison", "country_summary", "country_differences"])
def test_distinct_counts_merge_bitmaps(wh_small, key):
    df = QUERIES[key](wh_small)
    assert "Expand" not in plan(df) and "bitmap_or_agg" in df._jdf.queryExecution().toString()
    assert not any("/plays/" in f for f in df.inputFiles())


@pytest.mark.parametrize("key", ["hourly_heatmap", "monthly_trend", "skip_analysis", "country_peak_hours", "preview_by_year",
                                 "preview_by_country", "heatmap_grid", "monthly_period", "weather_listening", "rainy_vs_dry"])
def test_reports_by_time_and_country_read_the_roll_up(wh_small, key):
    files = QUERIES[key](wh_small).inputFiles()
    assert any("/activity/" in f for f in files) and not any("/plays/" in f for f in files)


@pytest.mark.parametrize("key", ["ingest_summary", "ingest_by_year"])
def test_distinct_counts_expand_groups_not_plays(wh_small, key):
    p = plan(QUERIES[key](wh_small))
    below = p[p.index("Expand"):]
    # between the plays and the copies there are both steps of an aggregate
    assert below.index("HashAggregate") < below.index("Exchange") < below.index("FileScan")


def test_reports_read_what_the_build_stored(wh_small):
    for key in ("completion_leaders", "completion_leaders_strict"):
        assert "stream_id" not in plan(QUERIES[key](wh_small)) and "minutes_played" not in plan(QUERIES[key](wh_small))
    p = plan(QUERIES["removed_rows"](wh_small))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)  # the stored row, and the clean table's row count
    assert set(schemas) == {"", "raw_rows:bigint,music_rows:bigint"}


def test_build_shuffles_grow_with_the_input(spark):
    from encore.operators import keys
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with keys.sized_shuffles(spark, 1000):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1000"
    with keys.sized_shuffles(spark, 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_reopened_warehouse_equals_built(spark, wh_small):
    """A completed build is found again by fingerprint and reads back equal."""
    from encore.sources import warehouse as W
    base = os.path.dirname(wh_small.root.rstrip("/"))
    assert W.completed_build(spark, base) is not None
    again = W.load_warehouse(spark, wh_small.root)
    for a, b in [(again.plays, wh_small.plays), (again.dim_tracks, wh_small.dim_tracks),
                 (again.dim_date(), wh_small.dim_date())]:
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    assert W.input_fingerprint(spark, SF_SMALL) in base


def _partial_before_exchange(p: str) -> bool:
    """A partial aggregate sits right below the topmost shuffle of the plan."""
    lines = p.splitlines()
    ex = min(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    nxt = lines[ex + 1] if ex + 1 < len(lines) else ""
    return "Aggregate(key" in nxt


def test_hot_key_operators_aggregate_map_side(spark, wh_small):
    """Dedupe, first-per-key and the features fallback reduce a hot key before shuffling."""
    from encore.operators import clean as clean_op, features, keys
    from encore.sources.adapters import raw_plays
    dedupe = clean_op.clean_plays(raw_plays(spark, SF_SMALL))
    assert _partial_before_exchange(plan(dedupe))
    firsts = keys.first_per_key(wh_small.clean, "track_uri", ["track_name"], ["album_name", "artist_name"])
    assert _partial_before_exchange(plan(firsts))
    api = wh_small.track_metadata.select("track_id", "duration_ms")
    assert "partial_count" in plan(features.track_features(wh_small.plays, api))
