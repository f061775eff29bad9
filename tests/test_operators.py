import datetime as dt
import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators import aggregates, joins, keys, nested, profile, sets
from siltstone.plans import risk


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, a sixth of the keys are null, one has no match."""
    random.seed(3)
    data = [
        ("hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{random.randrange(40)}", i) for i in range(1200)
    ]
    return data, spark.createDataFrame(data, "k string, v int").repartition(6)


HOT = [("hot",), ("k3",), ("nowhere",)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("parts", [["hot"], []])
@pytest.mark.parametrize("hot", [(), HOT])
def test_skew_join_equals_brute_force(spark, skewed, rows, how, parts, hot):
    data, df = skewed
    dim = {f"k{i}": i for i in range(0, 40, 2)} | dict.fromkeys(parts, 99) | {"only": 5}
    right = spark.createDataFrame(list(dim.items()), "k string, w int")
    got = joins.skew_join(df, right, ["k"], how, hot)
    expected = {
        "left": [(k, v, dim.get(k)) for k, v in data],
        "inner": [(k, v, dim[k]) for k, v in data if k in dim],
        "left_semi": [(k, v) for k, v in data if k in dim],
        "left_anti": [(k, v) for k, v in data if k not in dim],
    }[how]
    rows(got, expected)


def test_joins_run_no_job_and_read_each_side_once(spark, skewed):
    _, df = skewed
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int")
    group = "joins-while-built"
    spark.sparkContext.setJobGroup(group, group)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = df
        for n in range(5):
            joined = joins.skew_join(joined, right.withColumnRenamed("w", f"w{n}"), ["k"], "left", HOT)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        text = joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert text.count("ExistingRDD") == 6 and text.count("SortMergeJoin") == 5


def test_hot_keys_are_spread(spark, skewed):
    _, df = skewed
    right = spark.createDataFrame([("hot", 1)], "k string, w int")
    for setting, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(setting, value)
    try:
        joined = joins.skew_join(df, right, ["k"], "inner", HOT).withColumn("p", F.spark_partition_id())
        assert joined.select("p").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_skew_join_on_two_columns(spark, rows):
    data = [(1 if i % 2 else i, "a", i) for i in range(300)] + [(None, "a", -1), (1, None, -2)]
    df = spark.createDataFrame(data, "x int, y string, v int")
    dim = spark.createDataFrame([(1, "a", 7), (4, "a", 8), (6, "b", 9)], "x int, y string, w int")
    table = {(1, "a"): 7, (4, "a"): 8}
    rows(
        joins.skew_join(df, dim, ["x", "y"], "left", [(1, "a")]).select("x", "y", "v", "w"),
        [(x, y, v, table.get((x, y))) for x, y, v in data],
    )
    with pytest.raises(ValueError):
        joins.skew_join(df, dim, ["x", "y"], "full", [(1, "a")])


@pytest.mark.parametrize("hot", [(), HOT])
def test_one_to_many_equals_brute_force(spark, skewed, rows, hot):
    data, df = skewed
    people = [("hot",), ("k1",), ("k2",), ("lonely",), (None,), ("nowhere",), ("k3",), ("k3",)]
    dim = spark.createDataFrame(people, "k string")
    expected = []
    for (k,) in people:
        match = [v for kk, v in data if kk == k and k is not None]
        expected += [(k, v) for v in match] or [(k, None)]
    rows(joins.one_to_many(dim, df, ["k"], hot).select("k", "v"), expected)
    # A key that is hot in a raw table may be gone from the reduced one.
    without = df.where("k <> 'hot'")
    expected = [(k, v) for k, v in expected if k != "hot"] + [("hot", None)]
    rows(joins.one_to_many(dim, without, ["k"], hot).select("k", "v"), expected)


def test_matched_flag_does_not_fan_out(spark, skewed):
    _, df = skewed
    dim = spark.createDataFrame([("hot",), ("hot",), (None,), ("k1",)], "k string")
    got = joins.matched_flag(df, dim, ["k"], "f", hot=HOT)
    assert got.count() == df.count()
    assert got.where("f = 'Y' and k not in ('hot', 'k1')").count() == 0
    assert got.where("k is null and f <> ' '").count() == 0


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 100, 7])
@pytest.mark.parametrize("partitions", [1, 5])
def test_surrogate_ids_equal_the_naive_ones(spark, skewed, rows_per_bucket, partitions):
    data, df = skewed
    ordered = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    expected = {v: i for i, (_, v) in enumerate(ordered, start=1)}
    got = keys.surrogate_id(df.repartition(partitions), ["k", "v"], rows_per_bucket=rows_per_bucket)
    assert {r["v"]: r["id"] for r in got.collect()} == expected


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date", "double", "decimal(12,3)"])
def test_surrogate_ids_of_other_types(spark, kind):
    base = spark.range(500).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=F.col("id") * 25, secs=F.col("id") / 1000)).alias("t"), "id")
    value = {"timestamp_ntz": F.col("t"), "date": F.col("t").cast("date")}.get(kind, (F.col("id") * 1.125 - 200).cast(kind))
    got = keys.surrogate_id(base.select(value.alias("k"), "id"), ["k"], "n", rows_per_bucket=20)
    assert all(r["n"] == r["id"] + 1 for r in got.collect())


def test_surrogate_ids_deal_a_bounded_number_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(keys, "MAX_BUCKETS", 5, raising=False)
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("k")).repartition(4)
    got = keys.surrogate_id(df, ["k"], rows_per_bucket=10)
    assert len(got.inputFiles()) <= 5
    assert all(r["id"] == r["k"] + 1 for r in got.collect())


def test_surrogate_ids_of_an_empty_table(spark):
    assert keys.surrogate_id(spark.createDataFrame([], "k int"), ["k"]).count() == 0


ROWS = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)),
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1], r[2]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=ROWS, partitions=st.integers(1, 4))
def test_latest_per_key_any_order_any_partitioning(spark, data, partitions):
    df = spark.createDataFrame(data, "k int, t int, tie int").repartition(partitions)
    got = {tuple(r) for r in keys.latest_per_key(df, ["k"], "t", ["tie"]).collect()}
    expected = set()
    for k, group in itertools.groupby(sorted(data, key=lambda r: r[0]), key=lambda r: r[0]):
        expected.add(min(group, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])))
    assert got == expected


def test_first_per_key_puts_nulls_last(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (2, None, 3)], "k int, t int, v int")
    rows(keys.first_per_key(df, ["k"], "t", ["v"]), [(1, 5, 2), (2, None, 3)])


def test_dedup_newest_is_idempotent(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 12), ("b", None, 3), ("b", None, 4)], "x string, y int, ts int")
    once = keys.dedup_newest(df, "ts")
    rows(once, [("a", 1, 12), ("b", None, 4)])
    rows(keys.dedup_newest(once, "ts"), [("a", 1, 12), ("b", None, 4)])


def test_id_diff(spark, rows):
    today = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    before = spark.createDataFrame([(2,), (3,), (3,)], "id int")
    rows(sets.id_diff(today, before, "id"), [(1, "Only in Today"), (3, "Only in Yesterday")])
    rows(sets.id_diff(today, before, "id", labelled=False), [(1,), (3,)])
    assert sets.id_diff(today, today, "id").count() == 0


def test_pairs_and_work_list(spark, rows):
    df = spark.createDataFrame([("d", "GBPUSD", 1.2), ("d", "GBPEUR", 1.1)], "day string, p string, v double")
    rows(joins.pairs_to_columns(df, ["day"], "p", "v", ["GBPUSD", "GBPAED"]), [("d", 1.2, None)])
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    days = joins.work_list(ids, dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    assert days.count() == 6


# ---------------------------------------------------------------- nested


def test_flatten_names_and_widths(spark):
    data = [(1, {"b": 2, "c": [{"d": "x"}, {"d": "y"}]}, [[1, 2], [3]], []), (2, None, [[4]], None)]
    df = spark.createDataFrame(data, "id int, a struct<b:int,c:array<struct<d:string>>>, m array<array<int>>, e array<int>")
    flat = nested.flatten(df)
    assert flat.columns == ["id", "a_b", "a_c_0_d", "a_c_1_d", "m_0_0", "m_0_1", "m_1_0", "m_1_1", "e"]
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [
        (1, 2, "x", "y", 1, 2, 3, None, "[]"), (2, None, None, None, 4, None, None, None, None),
    ]


def test_flatten_options(spark):
    df = spark.createDataFrame([((1,), (2,), [5])], "skip struct<x:int>, k struct<`a_b`:int>, l array<int>")
    assert nested.flatten(df, sep="_", ignore=["skip"], replace_sep="-").columns == ["k_a-b", "l_0"]
    assert nested.flatten(df, max_items=2).columns == ["skip_x", "k_a_b", "l_0", "l_1"]


def test_flatten_never_loses_items(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "l array<int>")
    with pytest.raises(PySparkException, match="more than 2 items"):
        nested.flatten(df, max_items=2).collect()


def test_items_to_columns_never_loses_items(spark, rows):
    df = spark.createDataFrame([("a", 0, 5), ("a", 2, 6), ("b", 1, 7)], "k string, p int, v int")
    rows(nested.items_to_columns(df, ["k"], "p", ["v"], 3), [("a", 5, None, 6), ("b", None, 7, None)])
    with pytest.raises(PySparkException, match="beyond 1"):
        nested.items_to_columns(df, ["k"], "p", ["v"], 2).collect()


def test_flatten_refuses_colliding_names(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="twice"):
        nested.flatten(df)


def test_flatten_columns_keeps_row_alignment(spark, rows):
    df = spark.createDataFrame([(1, None), (2, '{"v": 5}'), (3, "junk"), (4, "{'v': None}")], "id int, doc string")
    rows(nested.flatten_columns(df, {"doc": "v int"}), [(1, None), (2, 5), (3, None), (4, None)])


def test_page_records(spark):
    pages = spark.createDataFrame(
        [([(("T", "u"), "1", None)],), ([(("T", "u"), "2", "r"), (("T", "u"), "3", None)],), ([],)],
        "records array<struct<attributes:struct<type:string,url:string>,Id:string,Reason:string>>",
    )
    flat = nested.page_records(pages, "records")
    assert flat.columns == ["Id", "Reason"]
    assert sorted(r["Id"] for r in flat.collect()) == ["1", "2", "3"]


def test_arrivals(spark, rows):
    good = '{"Records":[{"eventSource":"aws:s3","s3":{"bucket":{"name":"b"},"object":{"key":"in/a%20b+c.csv"}}}]}'
    other = good.replace("aws:s3", "aws:sns")
    df = spark.createDataFrame([("m1", good), ("m2", other), ("m3", '{"Event":"s3:TestEvent"}'), ("m4", "broken")], "id string, body string")
    rows(nested.arrivals(df, "body", keep=["id"]), [("m1", "b", "in/a b c.csv")])


def test_props_defaults(spark, rows):
    df = spark.createDataFrame([('{"brandId": 7, "type": null}',), (None,), ("broken",)], "p string")
    rows(nested.props(df, "p", ["brandId", "type"]).drop("p"), [("7", ""), ("", ""), ("", "")])


# ---------------------------------------------------------------- inference


def infer(spark, values, name="c", rules="dates", kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"`{name}` {kind}")
    return profile.infer_schema(df, rules)[name]


@pytest.mark.parametrize(
    "values,expected",
    [(["01/02/2024", "15-03-2024"], "date"), (["2024-01-01", "2024-01-02 10:00:00"], "string"),
     (["word"], "string"), ([None, None], "date"), (["2024-01-01", None], "date"), ([], "date")],
)
def test_date_columns(spark, values, expected):
    assert infer(spark, values) == expected


@pytest.mark.parametrize("kind,value,expected", [("boolean", True, "boolean"), ("int", 1, "int"), ("bigint", 1, "bigint"), ("double", 1.0, "double"), ("timestamp", dt.datetime(2024, 1, 1), "timestamp")])
def test_native_types(spark, kind, value, expected):
    assert infer(spark, [value], kind=kind) == expected


@pytest.mark.parametrize(
    "name,values,expected",
    [("c", ["1", "None", "-5"], "int"), ("c", ["1", "3000000000"], "bigint"), ("c", ["1", "2.5"], "double"),
     ("c", ["true", "False"], "boolean"), ("c", ["true", "1"], "string"), ("c", ["", "None"], "string"),
     ("c", ["99999999999999999999999"], "string"), ("c", ["007"], "string"),
     ("made", ["2024-01-01", "2024-01-02"], "date"), ("made", ["2024-01-01T10:00:00"], "timestamp"),
     ("date", ["2024-01-01"], "string"), ("due_date", ["20240101", "20240102"], "date")],
)
def test_content_rules(spark, name, values, expected):
    assert infer(spark, values, name, "content") == expected


@pytest.mark.parametrize(
    "values,expected",
    [(["1", "2"], "int"), (["1", None], "double"), (["1.5"], "double"), ([None, ""], "string"), (["x"], "string")],
)
def test_number_rules(spark, values, expected):
    assert infer(spark, values, rules="numbers") == expected


# ---------------------------------------------------------------- sums and merge


def test_class_sums_use_each_items_own_amount(spark, rows):
    data = [
        ("c1", "SALARY", "GBP_10_20", None, "GBP_5_6", "X", None),
        ("c1", "SALARY", "GBP_10_20", None, "GBP_5_6", "X", None),
        ("c1", "OTHER", "GBP_x_1", "SALARY", "GBP_3_4", "SALARY", "GBP"),
        ("c2", "SALARY", "GBP_3000000000_1", "SALARY", "GBP_100.5_200", None, None),
    ]
    df = spark.createDataFrame(data, "c string, t0 string, r0 string, t1 string, r1 string, t2 string, r2 string")
    got = aggregates.class_sums(df, "c", [("t0", "r0"), ("t1", "r1"), ("t2", "r2")], {"income": ["SALARY"]}, "wealth", "bad")
    rows(
        got.selectExpr("c", "cast(income as double)", "cast(wealth as double)", "bad"),
        [("c1", 13.0, 5.0, 1), ("c2", 3000000100.5, 0.0, 0)],
    )


def test_sums_keep_all_decimals_and_count_unreadable_amounts(spark, rows):
    df = spark.createDataFrame([("k", "0.005"), ("k", "0.004"), ("k", "0.004"), ("k", "n/a"), ("k", None)], "k string, a string")
    got = aggregates.filtered_sums(df, ["k"], F.col("a"), {"total": F.lit(True)}, unreadable="bad")
    rows(got, [("k", 0.013, 1)])


def test_wide_scores_are_not_cut(spark):
    item = "struct<type:string,converted:struct<code:string,from:double,to:double>,local:struct<code:string,from:double,to:double>>"
    worth = "struct<converted:struct<code:string,from:double,to:double>,local:struct<code:string,from:double,to:double>,code:string,from:double,to:double>"
    one = ("SAVINGS_FROM_SALARY_OR_EARNINGS", ("GBP", 1.0, 2.0), ("GBP", 1.0, 2.0))
    df = spark.createDataFrame(
        [("c", None, "2024-01-01", [one] * 35, None)],
        f"customer_id string, alt_customer_id string, updated_at string, items array<{item}>, net_worth {worth}",
    )
    with pytest.raises(PySparkException):
        risk.score_table(df).collect()
    assert risk.score_table(df, items=35).first()["item_34_type"] == one[0]
    assert float(risk.wealth_and_income(df).first()["income_salary"]) == 35.0



def merge(prev, now):
    return sets.snapshot_merge(
        prev, now, "k",
        lambda old, new: [old("k").alias("k"), F.coalesce(new("s"), old("s")).alias("s"), F.lit("kept").alias("how")],
        lambda new: [new("k").alias("k"), new("s").alias("s"), F.lit("new").alias("how")],
        lambda new: new("s") != "done",
    )


def test_snapshot_merge(spark, rows):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, "done")], "k int, s string")
    empty = now.limit(0)
    rows(merge(empty, now), [(1, "a", "new"), (2, "b", "new")])
    rows(merge(now, now), [(1, "a", "kept"), (2, "b", "kept"), (3, "done", "kept")])
    prev = spark.createDataFrame([(1, "z"), (9, "y")], "k int, s string")
    rows(merge(prev, now), [(1, "a", "kept"), (9, "y", "kept"), (2, "b", "new")])


def test_run_summary(spark, rows):
    df = spark.createDataFrame([("p1", 3), ("p1", None), ("p2", 2)], "u string, n int")
    summary = profile.run_summary(df, ["u"], F.col("n").isNotNull(), F.col("n"))
    rows(summary, [("p1", 1, 1, 3, "partial"), ("p2", 1, 0, 2, "completed")])
    rows(profile.overall_status(summary), [(2, 1, 5, "partial")])


def test_ties_do_not_depend_on_the_partitioning(spark):
    data = [("u", dt.datetime(2024, 1, 1), "S", f"brand{i % 50}", {"m": str(i)}) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, status string, brand string, bag map<string,string>")
    for pick, ties in itertools.product((keys.latest_per_key, keys.first_per_key), ([], ["status"])):
        found = {pick(df.repartition(n).drop("bag"), ["k"], "ts", ties).first()["brand"] for n in (1, 3, 5, 7)}
        assert found == {"brand0"}
    assert keys.latest_per_key(df, ["k"], "ts").count() == 1


def test_dedup_newest_refuses_to_drop_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, ts int")
    assert keys.dedup_newest(df, "ts", ["b", "a"]).columns == ["b", "a", "ts"] or keys.dedup_newest(df, "ts").count() == 1
    with pytest.raises(ValueError, match="leave columns out"):
        keys.dedup_newest(df, "ts", ["a"])
