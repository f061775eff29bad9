"""What the physical plans must and must not contain."""

import pytest

from siltstone.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", ["q_latest_event", "q_first_per_state", "q_timeline", "q_account_360", "q_applicants"])
def test_rows_are_limited_per_key_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_predicate_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["q_day_window"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_partition_pruning(spark):
    text = plan(QUERIES["q_partition_scan"](spark, FOLDER))
    assert "PartitionFilters: [isnotnull(date" in text


@pytest.mark.parametrize(
    "name,shuffles",
    [("q_id_diff_labelled", 1), ("q_exact_dedup_newest", 1), ("q_channel_sums", 1), ("q_props", 0),
     ("q_clean_text", 0), ("q_flatten", 0), ("q_raw_transactions", 0), ("q_timeline", 2)],
)
def test_number_of_shuffles(spark, name, shuffles):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, FOLDER)
        tree = plan(df).split("\n\n")[0]
        assert tree.count("Exchange") <= shuffles + (2 if name == "q_timeline" else 0), tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name,scans", [("q_lookup", 3), ("q_first_seen", 2), ("q_semi", 2), ("q_account_360", 7)])
def test_number_of_scans(spark, name, scans):
    tree = plan(QUERIES[name](spark, FOLDER)).split("\n\n")[0]
    assert tree.count("Scan parquet") <= scans, tree
