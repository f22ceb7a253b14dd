"""Row order of every sorted query, and reports of another length, against the oracle."""

import pytest

from encore.plans import listening, oracle, previews
from encore.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, norm

DAY = oracle.WEEKDAY_RANK.format(c="day_of_week")
SEASON = oracle.SEASON_RANK.format(c="season")
# ORDER BY of the queries that return all their groups; the others are cut by theirs
ORDERS = {
    "platform_counts": "streams DESC, platform_group",
    "ingest_by_year": "year",
    "hourly_heatmap": f"{DAY}, hour",
    "monthly_trend": "year, month",
    "year_comparison": "year",
    "skip_analysis": "year, country",
    "country_summary": "total_streams DESC, country",
    "country_top_artists": "country, country_rank",
    "country_peak_hours": "country, hour_rank",
    "weather_listening": f"country, {SEASON}, temp_category",
    "rainy_vs_dry": f"country, {SEASON}, day_type DESC",
    "preview_by_year": "year",
    "preview_by_country": "streams DESC, country",
    "weather_by_season": f"country, {SEASON}",
    "weather_hours": f"country, hours_listened DESC, {SEASON}, temp_category",
    "weather_coverage": "country",
    "heatmap_grid": DAY,
    "monthly_period": "year, month",
}
LENGTHS = [("top_artists", listening.top_artists), ("top_tracks", listening.top_tracks),
           ("completion_leaders", listening.completion_leaders), ("hidden_gems", listening.hidden_gems),
           ("preview_top_artists", previews.preview_top_artists), ("popular_tracks", previews.popular_tracks),
           ("most_completed", previews.most_completed), ("most_skipped", previews.most_skipped)]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _same_rows_in_order(df, con, sql):
    rel = con.sql(sql)
    want = [tuple(map(norm, r)) for r in rel.fetchall()]
    got = [tuple(map(norm, r)) for r in df.select(*rel.columns).collect()]
    assert got == want


@pytest.mark.parametrize("key", sorted(ORDERS))
def test_sorted_as_stated(con, wh_small, key):
    _same_rows_in_order(QUERIES[key](wh_small), con, f"SELECT * FROM ({oracle.sql_for(key)}) ORDER BY {ORDERS[key]}")


@pytest.mark.parametrize("key", ["country_counts", "recent_months", "heatmap_monday"])
def test_cut_in_order(con, wh_small, key):
    _same_rows_in_order(QUERIES[key](wh_small), con, oracle.sql_for(key))


@pytest.mark.parametrize("n", [None, 8, 10])
@pytest.mark.parametrize("key, query", LENGTHS)
def test_leading_rows_of_any_length(con, wh_small, key, query, n):
    df = query(wh_small, **({"n": n} if n else {}))
    _same_rows_in_order(df, con, oracle.sql_for(key, n))
