"""Every registered query against its SQL oracle, over whole tables."""

import os

import pytest

from siltstone.queries import ORACLES, QUERIES
from tests.oracle_check import connect, difference, oracle_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# No Python in the tasks and no join that pairs every row with every row.
REFUSED = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups",
    "CartesianProduct", "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    text = df._jdf.queryExecution().toString()
    assert not [node for node in REFUSED if node in text]
    got = spark_rows(df)
    if name in ORACLES:
        assert difference(got, oracle_rows(oracle, ORACLES[name])) is None
    else:
        assert got[1]


@pytest.mark.parametrize(
    "name",
    ["q_lookup", "q_join_detail", "q_semi", "q_new_keys", "q_matched_flag", "q_one_to_many", "q_first_seen",
     "q_joined_since", "q_latest_with_ties", "q_student_flag", "q_changed_children", "q_account_360",
     "q_risk_report", "q_skew_join"],
)
def test_joins_without_broadcast_give_the_same_rows(spark, oracle, name):
    """The plan of large tables, with skewed partitions split down to a few bytes."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = spark_rows(QUERIES[name](spark, FOLDER))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert difference(got, oracle_rows(oracle, ORACLES[name])) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
