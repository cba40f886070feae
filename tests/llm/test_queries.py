"""Registered queries against their SQL on the smallest tables, and the registration itself."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tableshift.llm import ORACLES, QUERIES
from tests import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    df, con = QUERIES[name](spark, FOLDER), oracle.connect(FOLDER)
    assert oracle.compare(df, con, ORACLES[name]) is None
    assert oracle.type_differences(df, con, ORACLES[name]) == {}


def test_all_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
