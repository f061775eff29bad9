"""Schema versions, stored profiles, dead letters and documents of unknown shape."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import nested, stored_profile
from siltstone.operators.keys import first_seen, latest_with_ties
from siltstone.operators.profile import MEASURES, infer_schema, profile
from siltstone.session import work_path
from siltstone.sources import evolution, readers
from siltstone.streaming import arrivals, dead_letters


def kind(ddl):
    return T.StructType.fromDDL(f"x {ddl}")[0].dataType


@pytest.mark.parametrize(
    "one,other,joined",
    [("int", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "double", "string"), ("float", "double", "double"),
     ("date", "timestamp", "string"), ("boolean", "int", "string"), ("decimal(5,2)", "decimal(9,4)", "decimal(9,4)"),
     ("decimal(38,0)", "decimal(38,10)", "string"), ("void", "date", "date"), ("array<int>", "array<bigint>", "array<bigint>"),
     ("struct<a:int,b:string>", "struct<b:int,c:date>", "struct<a:int,b:string,c:date>"), ("array<int>", "int", "string"),
     ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("string", "int", "string")],
)
def test_types_have_a_least_join(spark, one, other, joined):
    for a, b in ((one, other), (other, one)):
        found = evolution.join_types(kind(a), kind(b))
        assert sorted(found.simpleString()) == sorted(kind(joined).simpleString())
        # What was joined once takes in nothing more.
        assert evolution.join_types(found, kind(a)) == found


def test_versions_lose_nothing(spark):
    root = work_path(spark, "versions")
    frames = [
        spark.createDataFrame([(1, (7, "x"), [1])], "id int, doc struct<a:int,b:string>, many array<int>"),
        spark.createDataFrame([(2**40, "new")], "id bigint, late string"),
        spark.createDataFrame([("three", (2**50, "y", True), "plain")], "id string, doc struct<a:bigint,b:string,c:boolean>, many string"),
        spark.createDataFrame([], "id string, hollow double"),
    ]
    for i, df in enumerate(frames):
        assert evolution.append(df, root, f"v{i}") == i + 1
    assert evolution.append(frames[0], root, "v0") == 1
    rows = {r["id"]: r for r in evolution.read_evolved(spark, root).collect()}
    assert set(rows) == {"1", str(2**40), "three"}
    assert rows["1"]["doc"].asDict() == {"a": 7, "b": "x", "c": None} and rows["1"]["many"] == "[1]"
    assert rows["three"]["doc"].asDict() == {"a": 2**50, "b": "y", "c": True}
    assert rows[str(2**40)]["late"] == "new" and rows[str(2**40)]["doc"] is None
    assert evolution.conflicts(spark, root) == {"id": ["int", "bigint", "string"], "many": ["array<int>", "string"]}
    plan = evolution.read_evolved(spark, root).select("late")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<late:string>" in plan
    with pytest.raises(ValueError, match="case"):
        evolution.append(spark.createDataFrame([(1,)], "ID int"), root, "bad")
    with pytest.raises(ValueError):
        evolution.read_evolved(spark, work_path(spark, "none"))


def test_merged_profiles_equal_the_profile_of_all_rows(spark):
    landed, root = work_path(spark, "landed"), work_path(spark, "profile")
    parts = [[("1", "2024-01-02", "true"), ("2", None, "")], [("70000000000", "2024-01-03", "x")], [("4.5", "2024-05-01 10:00:00", None)]]
    types = []
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "a string, b string, c string").coalesce(1).write.mode("append").parquet(landed)
        stored_profile.profile_new_files(spark, landed, root, f"run-{i}", glob="*.parquet")
        stored_profile.profile_new_files(spark, landed, root, f"run-{i}", glob="*.parquet")
        types.append(stored_profile.inferred_schema(spark, root)["a"])
    assert types == ["int", "bigint", "double"]  # wider as new files need it
    whole = spark.read.parquet(landed)
    merged = {r["column_name"]: [r[m] for m in MEASURES] for r in stored_profile.merged_profile(spark, root).collect()}
    for r in profile(whole).collect():
        want = [r[m] for m in MEASURES]
        if r["n_marked"] < r["n_set"]:
            want[10:] = want[10:] if r["n_time"] == merged[r["column_name"]][10] else merged[r["column_name"]][10:]
            assert merged[r["column_name"]][10] < r["n_set"]
        assert merged[r["column_name"]][:8] == want[:8]
    assert stored_profile.inferred_schema(spark, root) == infer_schema(whole)
    assert stored_profile.profile_new_files(spark, landed, root, "idle", glob="*.parquet") == 4
    assert stored_profile.inferred_schema(spark, root) == infer_schema(whole)


def test_a_truncated_file_is_named_and_the_stream_goes_on(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for name in ("a", "b", "c"):
        lines = "\n".join(json.dumps({"id": i, "v": name * 50}) for i in range(200)) + "\n{broken\n"
        (landing / f"{name} 1.json.gz").write_bytes(gzip.compress(lines.encode())[: 60 if name == "b" else None])
    table, bad, ledger, checkpoint = (work_path(spark, n) for n in ("table", "bad", "ledger", "checkpoint"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    sink = dead_letters.sifting(arrivals.batch_writer(table, quarantine=bad), ledger, schema, attempts=3)
    for _ in range(2):
        arrivals.run_available(dead_letters.path_stream(spark, str(landing), "*.json.gz"), sink, checkpoint)
    assert readers.read_table(spark, table).groupBy("v").count().count() == 2
    assert readers.read_table(spark, table).count() == 400
    assert readers.read_table(spark, bad).count() == 2
    dead = dead_letters.dead_letters(spark, ledger, 3).collect()
    assert len(dead) == 1 and "b 1.json.gz" in dead[0]["file"].replace("%20", " ") and dead[0]["attempts"] == 3 and dead[0]["error"]
    assert dead_letters.dead_letters(spark, ledger, 4).count() == 0


def test_errors_that_no_file_explains_fail_the_batch(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'{"id": 1}\n'))

    def broken_sink(batch, batch_id, run):
        raise RuntimeError("no room")

    sink = dead_letters.sifting(broken_sink, work_path(spark, "ledger"), T.StructType([T.StructField("id", T.LongType())]), attempts=2)
    with pytest.raises(Exception, match="no room"):
        arrivals.run_available(dead_letters.path_stream(spark, str(tmp_path), "*.json.gz"), sink, work_path(spark, "checkpoint"))


def test_documents_of_unknown_shape(spark):
    texts = ['{"a": 1, "b": {"c": [1, {"d": "x"}]}}', '{"a": "one", "b": {"c": []}, "odd: OBJECT<name": true}', "5", "no json", None, '{"b": null, "z": 2.5}']
    df = spark.createDataFrame([(i, t, (i,)) for i, t in enumerate(texts)], "id int, doc string, other struct<x:int>")
    rows = nested.flatten_json(df.where("id <> 2"), "doc", broken="bad").orderBy("id").collect()
    assert rows[0]["doc_a"] == "1" and rows[1]["doc_a"] == "one" and rows[4]["doc_a"] is None
    assert rows[0]["doc_b_c_0"] == "1" and json.loads(rows[0]["doc_b_c_1"]) == {"d": "x"}
    assert rows[1]["doc_odd: OBJECT<name"] is True
    assert str(rows[4]["doc_z"]) == "2.5"
    assert [r["bad"] for r in rows] == [None, None, "no json", None, None]
    assert rows[0]["other"].x == 0  # other columns stay as they are
    mixed = nested.flatten_json(df.where("id in (0, 2)"), "doc").orderBy("id").collect()
    assert json.loads(mixed[0]["doc"])["a"] == 1 and mixed[1]["doc"] == "5"
    assert nested.flatten_json(df.where("id = 4"), "doc").first()["doc"] is None


@pytest.mark.parametrize("query", [lambda df: first_seen(df, ["k"], "ts"), lambda df: latest_with_ties(df, ["k"], "ts")])
def test_a_hot_key_is_split(spark, query):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        df = spark.range(0, 300_000, numPartitions=8).select(hot.alias("k"), (F.col("id") % 2).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = query(df)
        assert out.agg(F.count("pad")).first()[0] > 200_000
        counted = out.agg(F.bit_xor(F.xxhash64(*out.columns)))
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
