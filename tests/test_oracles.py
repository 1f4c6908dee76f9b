from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect, plan

SF, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "PythonRDD", "InPandas"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    """Equal to its SQL, and planned without pairs of all rows or Python."""
    df = entry.queries()[name](spark, SF)
    text = plan(df)
    assert not [word for word in UNWANTED if word in text]
    assert compare(df, con, name) == ""


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_on_more_rows(spark, name):
    """Cases that the smallest data lack."""
    assert compare(entry.queries()[name](spark, MORE), connect(MORE), name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 2
