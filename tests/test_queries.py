"""Every registered query against its SQL."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from verification.checks import CHECKS
from verification.compare import connect, difference


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKS)
def test_query(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 10 and all(row.totalVotes >= 30 for row in rows)


def test_registry():
    assert set(driver.oracle_sql()) <= set(driver.queries()) >= set(CHECKS)
    assert set(CHECKS) <= set(driver.oracle_sql())


def test_approximate_distinct_movies(spark):
    rough = {row.source: row for row in CHECKS["live_source_stats"].run(spark, SF_DIR).collect()}
    exact = CHECKS["source_stats_exact"].run(spark, SF_DIR).collect()
    assert len(exact) == len(rough)
    for row in exact:
        got = rough[row.source]
        assert (row.totalRatings, row.avgRating) == (got.totalRatings, got.avgRating)
        assert got.close and got.exactMovies == row.uniqueMovies
