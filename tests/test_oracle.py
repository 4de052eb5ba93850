"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tests.oracle_compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).limit(1).count() == 1


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    df = driver.entry(spark)
    assert df.columns and df.count() > 0


@pytest.mark.parametrize("name", ["resolved_trips", "points_in_areas", "neighbours_within_radius", "station_lines", "sheet_records",
                                  "place_class_matrix", "unique_files", "mapping_report", "service_frequency", "age_volume_at_places"])
def test_lookups_too_large_to_broadcast(spark, con, monkeypatch, name):
    """The split path of every lookup gives the same answers."""
    import pedalmill.session as session

    monkeypatch.setattr(session, "fits_broadcast", lambda *a, **k: False)
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) == []
