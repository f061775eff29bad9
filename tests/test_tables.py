import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from siltstone import schema as sc
from siltstone.plans import ingest
from siltstone.session import shared_dir
from siltstone.sources import readers, writers
from siltstone.streaming import arrivals

NOW = dt.datetime(2024, 5, 2, 10, 0)


def files(path, suffix):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(suffix)]


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="unsupported"):
        writers.write_table(spark.range(1), str(tmp_path / "x"), "xml")


def test_json_array_scan(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "amount": 100}, {"id": 2, "amount": 200}]))
    rows(readers.read_table(spark, str(tmp_path), "json-array", "id int, amount int"), [(1, 100), (2, 200)])


def test_schema_evolution_on_append(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    writers.write_table(spark.createDataFrame([(1,)], "a int"), path)
    writers.write_table(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    rows(readers.read_table(spark, path, mergeSchema="true"), [(1, None), (2, "x")])


def test_max_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(100).coalesce(1), path, max_rows=30)
    assert len(files(path, ".parquet")) == 4


def test_overwrite_replaces_everything(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    writers.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, partition_by=["p"])
    writers.write_table(spark.createDataFrame([(3, "c")], "v int, p string"), path, mode="overwrite", partition_by=["p"])
    rows(readers.read_table(spark, path), [(3, "c")])


def test_fallback_keeps_rows_and_raises(spark, tmp_path, rows):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    with pytest.raises(Exception):
        writers.write_with_fallback(df, str(blocked / "t"), str(tmp_path / "fallback"))
    rows(spark.read.schema("a int, b string").json(str(tmp_path / "fallback")), [(1, None)])


def test_comments_reach_the_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    writers.write_table(df, str(tmp_path / "t"), mode="overwrite", comments={"a": "the key"}, table="commented")
    try:
        found = {c.name: c.description for c in spark.catalog.listColumns("commented")}
        assert found["a"] == "the key"
        assert readers.list_columns(spark, "commented") == ["a", "b"]
    finally:
        spark.sql("drop table commented")


def test_describe_schema(spark):
    df = spark.createDataFrame([], "user_id bigint, name string, ok boolean, timestamp_extracted string")
    types, comments = sc.describe_schema(df, {"name": "given"})
    assert types == {"user_id": "float", "name": "string", "ok": "boolean", "timestamp_extracted": "timestamp"}
    assert comments["user_id"] == "This is the user id column." and comments["name"] == "given"


def test_declared_schema_round_trip():
    declared = {"a": "string", "b": "decimal(20,2)", "c": "timestamp"}
    struct = sc.to_struct(declared, {"a": "note"})
    assert sc.to_declared(struct) == declared and struct["a"].metadata == {"comment": "note"}


def test_compaction_splits_hot_days_and_swaps(spark, tmp_path):
    source, target = str(tmp_path / "old"), str(tmp_path / "new")
    df = spark.range(20_000).select(
        "id", F.sha2(F.col("id").cast("string"), 512).alias("pad"),
        F.when(F.col("id") % 10 < 9, "d1").otherwise("d2").alias("date"),
        F.lit(NOW).alias("timestamp_extracted"),
    )
    twice = df.unionByName(df.withColumn("timestamp_extracted", F.lit(NOW + dt.timedelta(days=1))))
    writers.write_table(twice.repartition(40), source, mode="overwrite", partition_by=["date"], table="balances")
    try:
        assert len(files(source, ".parquet")) == 80
        ingest.compact_balances(spark.table("balances"), target)
        writers.swap_location(spark, "balances", target)
        result = spark.table("balances")
        assert result.count() == 20_000
        assert result.select("timestamp_extracted").distinct().count() == 1
        assert len(files(target, ".parquet")) <= 4
    finally:
        spark.sql("drop table balances")
    with pytest.raises(ValueError, match="partition columns"):
        writers.compact(df, str(tmp_path / "x"), ["nope"])


def test_shared_dir_reads_the_session(spark):
    assert shared_dir(spark) == shared_dir(spark)


# ---------------------------------------------------------------- card and report files

SCHEMAS = {
    "fees": {"card": "string", "fee": "double", "source_file": "string"},
    "interchange": {"card": "string", "rate": "double"},
}


def test_card_files_with_different_column_orders(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x_Fees_20240101.csv").write_text("Card,FEE,junk\nc1,1.5,a\n")
    (folder / "x_Fees_20240102.csv").write_text("fee,Card\n2.5,c2\n")
    (folder / "x_Fees_20240103.csv").write_text("Card,FEE,junk\nc3,bad,a\n")
    (folder / "x_Interchange_20240101.csv").write_text("card,rate\nc1,0.1\n")
    (folder / "other.csv").write_text("card\nc1\n")
    empty = spark.createDataFrame([], "path string")
    frames, done = ingest.load_card_files(spark, str(folder), empty, SCHEMAS)
    rows(frames["fees"].drop("file_key"), [
        ("c1", 1.5, "x_Fees_20240101.csv"), ("c2", 2.5, "x_Fees_20240102.csv"), ("c3", None, "x_Fees_20240103.csv"),
    ])
    rows(frames["interchange"].drop("file_key"), [("c1", 0.1)])
    assert done.count() == 4
    again, _ = ingest.load_card_files(spark, str(folder), done, SCHEMAS)
    assert again == {}


def test_backfill_counts(spark, rows):
    files_df = spark.createDataFrame([("in/a_Fees_20210614.csv",), ("in/a_Fees_20210701.csv",)], "path string")
    none = files_df.limit(0)
    window = (dt.date(2021, 6, 14), dt.date(2021, 6, 30))
    rows(ingest.backfill_summary(ingest.backfill_plan(files_df, none, *window)), [(1, 1, 0)])
    undated = spark.createDataFrame([("in/a_Fees_x.csv",)], "path string")
    rows(ingest.backfill_summary(ingest.backfill_plan(undated, none, *window)), [(0, 0, 1)])
    rows(ingest.backfill_summary(ingest.backfill_plan(undated, none)), [(1, 1, 0)])
    rows(ingest.backfill_summary(ingest.backfill_plan(undated, undated)), [(1, 0, 1)])


def test_report_files_by_day(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    for day, records in {
        "20240101": [{"Id": 1, "Booked": "05/01/2024", "Amount": 1.5}],
        "20240102": [{"Id": 2, "Booked": "2024-01-06", "Amount": 2}],
        "20240105": [{"Id": 3, "Booked": "07/01/2024", "Amount": 3}],
    }.items():
        (folder / f"Balance_{day}0730.json").write_text(json.dumps(records))
    paths = ingest.report_files(spark, str(folder), "Balance", dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert [os.path.basename(p) for p in paths] == ["Balance_202401010730.json", "Balance_202401020730.json"]
    df = ingest.load_report(spark, paths, NOW).select("id", "booked", "amount", "date", "timestamp_extracted")
    assert sorted(tuple(r) for r in df.collect()) == [
        (1, dt.date(2024, 1, 5), 1.5, "20240101", NOW), (2, dt.date(2024, 1, 6), 2.0, "20240102", NOW),
    ]


def test_report_files_grow_with_rows_not_with_keys(spark, tmp_path):
    from siltstone.queries import QUERIES

    at = F.to_timestamp(F.lit("1996-05-03"))
    orders = spark.range(300).select(
        (F.col("id") * 20_011).alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.when(F.col("id") != 7, at).alias("o_orderdate"), F.col("id").cast("double").alias("o_totalprice"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    df = QUERIES["q_report_files"](spark, str(tmp_path))
    assert len(df.inputFiles()) == 1
    assert sorted(r["id"] for r in df.collect()) == [i * 20_011 for i in range(300) if i != 7]


def test_curated_events(spark, rows):
    df = spark.createDataFrame([("click", 1, "x"), ("view", 2, "y")], "event_type string, user_id int, extra string")
    out = ingest.curated_events(df, dt.date(2024, 5, 2), ["event_type", "user_id", "absent"])
    assert out.columns == ["event_type", "user_id", "year", "month", "day"]
    rows(out, [("click", 1, "2024", "05", "02"), ("view", 2, "2024", "05", "02")])


def test_positions(spark, rows):
    kind = "portfolio_id string, request_date date, records array<struct<date:string,dateAsString:string,qty:int>>"
    day = dt.date(2024, 1, 1)
    responses = spark.createDataFrame([("p1", day, [("01/01/2024", "20240101", 5)]), ("p2", day, None)], kind)
    out, summary = ingest.positions(responses, responses, day, day, NOW)
    rows(out, [("p1", "20240101", "01/01/2024", 5, NOW)])
    rows(summary, [("p1", 1, 0, 1, "completed"), ("p2", 0, 1, 0, "partial")])


# ---------------------------------------------------------------- streams


def land(folder, name, records):
    import gzip

    with gzip.open(folder / name, "wt") as f:
        f.write("\n".join(json.dumps(r) for r in records))


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, "a.json.gz", [{"id": 1}, {"id": 2}])
    (folder / "ignored.txt").write_text('{"id": 99}')
    table, bad, state = (str(tmp_path / n) for n in ("t", "bad", "state"))
    sink = arrivals.batch_writer(table, rules={"id": F.col("id") > 0}, quarantine=bad)

    def run():
        arrivals.run_available(arrivals.file_stream(spark, str(folder), "id int"), sink, state)

    run()
    run()
    rows(readers.read_table(spark, table).select("id"), [(1,), (2,)])
    land(folder, "b.json.gz", [{"id": 3}, {"id": -1}, {"id": "broken"}])
    run()
    rows(readers.read_table(spark, table).select("id"), [(1,), (2,), (3,)])
    rows(readers.read_table(spark, bad).select("id", "failed_rules"), [(-1, "id"), (None, "id")])


def test_repeated_batch_adds_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    sink = arrivals.batch_writer(table)
    batch = spark.range(5)
    sink(batch, 7)
    sink(batch, 7)
    sink(batch, 8)
    assert readers.read_table(spark, table).count() == 10


def test_a_batch_repeated_on_another_day_leaves_one_copy(spark, tmp_path):
    table = str(tmp_path / "t")
    sink = arrivals.batch_writer(table, ["day"])
    for day in ("02", "03"):
        sink(spark.range(5).withColumn("day", F.lit(day)), 7)
    assert sorted(r["day"] for r in readers.read_table(spark, table).collect()) == ["03"] * 5


def test_a_new_checkpoint_keeps_the_batches_of_the_old_one(spark, tmp_path):
    folder, table = tmp_path / "landing", str(tmp_path / "t")
    folder.mkdir()
    sink = arrivals.batch_writer(table)
    for n in range(2):
        land(folder, f"{n}.json.gz", [{"id": n}])
        arrivals.run_available(arrivals.file_stream(spark, str(folder), "id int", glob=f"{n}.json.gz"), sink, str(tmp_path / f"state{n}"))
    assert sorted(r["id"] for r in readers.read_table(spark, table).collect()) == [0, 1]


def test_rows_are_never_dropped_for_want_of_a_quarantine(spark, tmp_path):
    with pytest.raises(ValueError, match="quarantine"):
        arrivals.batch_writer(str(tmp_path / "t"), rules={"id": F.col("id") > 0})
