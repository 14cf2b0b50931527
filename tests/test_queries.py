"""Every registered query against its SQL twin on the smallest tables, and its plan."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402
import plans  # noqa: E402
from tallyloom.catalog.registry import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_scales(spark, name):
    """Without broadcasts: no cross product, no nested loop, no Python in the plan."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shape = plans.shape(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    bad = {"CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"} & set(shape)
    assert not bad
    if name != "agg_global":
        assert "Exchange SinglePartition" not in shape


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and set(QUERIES) <= set(entry.queries())
