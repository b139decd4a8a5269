"""Every named query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from playstream.checks import duckdb_sql
from playstream.checks.compare import compare, supplied_views
from playstream.plans import catalog
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return supplied_views(SMALL)


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith("stream_")])
def test_query_equals_its_sql(spark, con, name):
    good, note = compare(spark, con, name, SMALL)
    assert good, note


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n.startswith("stream_")])
def test_stream_equals_its_sql(spark, con, name):
    good, note = compare(spark, con, name, SMALL)
    assert good, note


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(duckdb_sql.oracle_sql())
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["title", "artist_name", "stream_count"]
