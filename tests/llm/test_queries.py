"""Registered training-data queries against their SQL, over whole tables."""

import os

import pytest

from siltstone.llm.queries import ORACLES, QUERIES
from tests.oracle_check import connect, difference, oracle_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NATIVE = ("op3_sharding", "op5_url_filter", "op9_quality")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "PythonRDD")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    assert difference(spark_rows(QUERIES[name](spark, FOLDER)), oracle_rows(oracle, ORACLES[name])) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not [node for node in (*PYTHON, "CartesianProduct", "BroadcastNestedLoopJoin") if node in plan]


def test_entry_registers_all_operators_and_the_pipeline():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {f"{n.split('_')[0]}_" for n in names if n.startswith("op")}
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= names
