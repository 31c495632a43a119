"""Every registered query with SQL agrees with DuckDB; the others return rows."""

import pytest
from compare import database, differences

from telemill.catalog import ALL

# Covered by their own tests, too slow to repeat here.
SLOW = {"m5_grid_search", "m12_automl", "m11_support_vectors", "m8_score_batches", "x4_stream_scoring"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("query", [q for q in ALL if q.sql], ids=lambda q: q.name)
def test_matches_sql(spark, sf_dir, con, query):
    assert differences(query.run(spark, sf_dir), con, query.sql) == []


@pytest.mark.parametrize("query", [q for q in ALL if not q.sql and q.name not in SLOW], ids=lambda q: q.name)
def test_returns_rows(spark, sf_dir, query):
    assert query.run(spark, sf_dir).count() > 0


def test_names_are_unique():
    assert len({q.name for q in ALL}) == len(ALL)
