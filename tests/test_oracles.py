"""Every registered query against its SQL on the given tables."""

import pytest

from __spark_entry__ import entry
from tableshift.queries import ORACLES, QUERIES
from tests import oracle

FOLDER = "/root/testdata/sf0.001"


# Reports that are rightly empty on the smallest tables.
EMPTY = ()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df, sql = QUERIES[name](spark, FOLDER), ORACLES[name]
    assert oracle.compare(df, con, sql) == ("both empty" if name in EMPTY else None)
    assert oracle.type_differences(df, con, sql) == {}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).columns == ["database", "table", "rows_old", "rows_new", "identical"]


def test_other_session_zone(spark, con):
    """Wall-clock stamps do not depend on the session's zone, not even in the hours a zone skips."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("digest_bag", "write_gaps", "stream_windows", "stream_sessions", "pause_length"):
            assert oracle.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
