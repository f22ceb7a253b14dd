"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from encore.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    # the training-data queries that SQL can't express are tested beside them
    assert set(catalog.for_tables()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["artist_name", "hours_listened", "total_streams", "skip_pct", "unique_tracks"]
    assert 0 < len(rows) <= 15


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, wh_small, key):
    ok, n, _, _, detail = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert ok, detail
