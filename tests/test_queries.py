"""Every registered query against its SQL, over whole tables."""

import pytest
from check_oracles import connect, difference

import __spark_entry__ as entry
from bindings.oracles import ORACLES
from bindings.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_entry_has_rows(spark):
    found = entry.entry(spark)
    assert found.columns[:2] == ["trade_hour", "symbol"]
    assert found.limit(1).count() == 1


@pytest.mark.parametrize("name", ["trade_metrics", "enrich_trades", "market_event_summary"])
def test_result_does_not_depend_on_the_session_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert difference(spark, con, name, SF_DIR) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
