"""Every registered query gives the rows its SQL gives, by a plan that can grow."""

import re

import pytest
from compare import connect, difference
from conftest import SF_DIR, plan

from __spark_entry__ import entry, oracle_sql, queries
from tidewell.workload.oracle import ORACLE
from tidewell.workload.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "revenue", "units"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    text = plan(df)
    assert not re.search(r"Python|BatchEval|ArrowEval|MapInPandas", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert difference(df, con, ORACLE[name]) is None
