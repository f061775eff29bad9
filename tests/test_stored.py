"""States, digests, snapshots and file lists that are kept between runs."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import id_digests, latest_state
from siltstone.operators.keys import first_per_key, latest_per_key
from siltstone.operators.numbering import numbered
from siltstone.queries import QUERIES, stored
from siltstone.session import work_path
from siltstone.sources import compaction, snapshots, versions, writers

FOLDER = "/root/testdata/sf0.001"
LOG = "key long, at long, value string, note string"


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def log_rows(seed, n, keys=30):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(keys)]), rng.choice([None, *range(50)]), rng.choice("abc"), rng.choice(["x", None])) for _ in range(n)]


@pytest.mark.parametrize("oldest", [False, True])
def test_state_of_deltas_equals_a_full_rebuild(spark, oldest):
    parts = [log_rows(s, n) for s, n in ((1, 200), (2, 0), (3, 90), (4, 5))]
    root = work_path(spark, "state")
    pick = first_per_key if oldest else latest_per_key
    for i in (2, 0, 1, 3, 0, 3):  # late, empty and repeated batches
        delta = spark.createDataFrame(parts[i], LOG)
        latest_state.advance(delta, root, f"b{i}", ["key"], "at", ["value"], oldest=oldest, buckets=8)
    whole = pick(spark.createDataFrame(sum(parts, []), LOG), ["key"], "at", ["value"])
    assert sorted(latest_state.state(spark, root).collect(), key=str) == sorted(whole.collect(), key=str)
    assert versions.latest(spark, root) == 4
    assert versions.version_of(spark, root, "b2") == 1


def test_a_run_reads_its_delta_and_rewrites_touched_buckets_only(spark):
    root, log = work_path(spark, "state"), work_path(spark, "log")
    rows = spark.createDataFrame([(k, d, "v", "n", f"d{d}") for d in (1, 2) for k in (range(100) if d == 1 else [7])], LOG + ", day string")
    rows.write.partitionBy("day").parquet(log)
    first = spark.read.parquet(log).where("day = 'd1'").drop("day")
    second = spark.read.parquet(log).where("day = 'd2'").drop("day")
    assert "PartitionFilters: [isnotnull(day" in plan(latest_per_key(second, ["key"], "at"))
    latest_state.advance(first, root, "one", ["key"], "at", buckets=16)
    latest_state.advance(second, root, "two", ["key"], "at", buckets=16)
    written = {r["bucket"]: r["written"] for r in versions.entries(spark, root).where("version = 2").collect()}
    assert sorted(written.values()).count(2) == 1
    state = {r["key"]: r["at"] for r in latest_state.state(spark, root).collect()}
    assert state == {k: 2 if k == 7 else 1 for k in range(100)}
    assert {r["at"] for r in latest_state.state(spark, root, 1).collect()} == {1}


def test_a_run_that_died_before_its_entry_counts_for_nothing(spark):
    root = work_path(spark, "state")
    latest_state.advance(spark.createDataFrame([(1, 1, "a", "n")], LOG), root, "one", ["key"], "at")
    # Files of a version that no entry names.
    spark.createDataFrame([(9, 9, "lost", "n", 0)], LOG + ", key_bucket int").write.partitionBy("key_bucket").parquet(f"{root}/data/version=2")
    assert [r["key"] for r in latest_state.state(spark, root).collect()] == [1]
    assert latest_state.advance(spark.createDataFrame([(2, 1, "b", "n")], LOG), root, "two", ["key"], "at") == 2
    assert sorted(r["key"] for r in latest_state.state(spark, root).collect()) == [1, 2]
    with pytest.raises(ValueError):
        latest_state.state(spark, work_path(spark, "nothing"))


def test_only_unequal_buckets_are_read(spark):
    root = work_path(spark, "ids")
    ids = spark.range(2000).withColumnRenamed("id", "user")
    id_digests.write_ids(ids.unionByName(ids.limit(50)), "user", root, "1", 32)
    id_digests.write_ids(ids.where("user <> 11").unionByName(spark.range(5000, 5001).withColumnRenamed("id", "user")), "user", root, "2", 32)
    buckets = id_digests.unequal_buckets(spark, root, "2", "1")
    assert 1 <= len(buckets) <= 2
    changed = id_digests.changed_ids(spark, root, "user", "2", "1")
    text = plan(changed)
    for b in buckets:
        assert "id_bucket#" in text and str(b) in text
    assert "PartitionFilters: [" in text
    assert {tuple(r) for r in changed.collect()} == {(11, "Only in Yesterday"), (5000, "Only in Today")}
    id_digests.write_ids(ids, "user", root, "3", 32)
    assert id_digests.unequal_buckets(spark, root, "3", "1") == []
    assert id_digests.changed_ids(spark, root, "user", "3", "1").count() == 0
    id_digests.write_ids(ids.limit(0), "user", root, "4", 32)
    assert id_digests.changed_ids(spark, root, "user", "3", "4").count() == 2000


def test_the_old_snapshot_is_not_moved(spark):
    path, name = work_path(spark, "snapshot"), "stored_snapshot_plan"
    old = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    snapshots.write_snapshot(old, name, path, "k", 8)
    now = spark.range(400, 600).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    merged = snapshots.merge_into_next(
        name, now, "k", lambda o, n: [o("k").alias("k"), F.coalesce(n("v"), o("v")).alias("v")], lambda n: [n("k").alias("k"), n("v").alias("v")], lambda n: n("k") < 550, 8
    )
    tree = plan(merged).split("\n\n")[0]
    scan = next(i for i, line in enumerate(tree.splitlines()) if "Scan parquet" in line)
    above = tree.splitlines()[:scan]
    join = max(i for i, line in enumerate(above) if "Join" in line)
    assert not [line for line in above[join:] if "Exchange" in line], tree
    assert tree.count("Exchange") == 1
    got = {r["k"]: r["v"] for r in merged.collect()}
    assert got == {k: "new" if k >= 400 else "old" for k in range(550)}
    spark.sql(f"drop table {name}")


def test_compaction_keeps_large_files_and_rows(spark):
    root = work_path(spark, "small files")
    rows = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.when(F.col("id") % 2 == 0, "a b").otherwise("c").alias("kind"))
    rows.where("id < 30000").repartition(1).write.partitionBy("kind").parquet(root)
    rows.where("id >= 30000").repartition(12, "id").write.mode("append").partitionBy("kind").parquet(root)
    compaction.register(spark, root)
    before = {r["path"]: r["bytes"] for r in compaction.live_files(spark, root).collect()}
    target = 0.3
    large = {p for p, b in before.items() if b * 2 >= target * 2**20}
    assert len(large) == 2 and len(before) == 26
    version = compaction.compact_small_files(spark, root, "run", ["kind"], target)
    after = {r["path"] for r in compaction.live_files(spark, root).collect()}
    # A small file that alone makes a group stays, too.
    assert large <= after and len(after) <= 8 and len(after & set(before)) <= 4
    live = compaction.read_live(spark, root)
    assert live.columns == ["id", "text", "kind"]
    assert sorted(live.collect()) == sorted(rows.collect())
    assert compaction.compact_small_files(spark, root, "run", ["kind"], target) == version
    again = compaction.compact_small_files(spark, root, "idle", ["kind"], 0.0001)
    assert again == version + 1 and {r["path"] for r in compaction.live_files(spark, root).collect()} == after


def test_rows_are_numbered_in_order_over_many_ranges(spark):
    rng = random.Random(1)
    values = [(rng.choice([None, *range(9)]), i) for i in range(500)]
    df = spark.createDataFrame(values, "a long, `b c` long").repartition(7)
    got = numbered(df, [F.col("a").asc_nulls_last(), F.col("`b c`").desc()], "n", partitions=13).collect()
    want = sorted(values, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert [tuple(r)[:2] for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(500))
    assert numbered(df.limit(0), [F.col("a")], "n").count() == 0


def test_units_are_replaced_inside_a_bounded_number_of_folders(spark):
    path = work_path(spark, "units")
    kind = "date string, unit string, n long"
    first = [(d, u, i) for d in ("a", "b") for u in [None, *map(str, range(90))] for i in (1, 2)]
    writers.replace_units(spark.createDataFrame(first, kind), path, ["date", "unit"], buckets=4)
    second = [("a", "7", 70), ("a", None, 0), ("b", "new", 5)]
    for _ in range(2):  # a repeated run changes nothing
        writers.replace_units(spark.createDataFrame(second, kind), path, ["date", "unit"], buckets=4)
    got = sorted(spark.read.parquet(path).select("date", "unit", "n").collect(), key=str)
    want = [r for r in first if (r[0], r[1]) not in {("a", "7"), ("a", None)}] + second
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert spark.read.parquet(path).select("date", "unit_bucket").distinct().count() <= 8
    writers.replace_units(spark.createDataFrame([], kind), path, ["date", "unit"], buckets=4)
    assert spark.read.parquet(path).count() == len(want)
    with pytest.raises(ValueError, match="partition"):
        writers.replace_units(spark.createDataFrame([], kind), path, ["unit"])


@pytest.mark.parametrize("name, table, size", [("q_json_array_ranges", "orders", 100), ("q_csv_ranges", "documents", 20_000)])
def test_deliveries_are_dealt_over_files_of_bounded_size(spark, tmp_path, monkeypatch, name, table, size):
    monkeypatch.setattr(stored, "work_path", lambda _, folder: str(tmp_path / folder))
    for limit in ("_FILE_ROWS", "_FILE_BYTES"):
        monkeypatch.setattr(stored, limit, size, raising=False)
    got = QUERIES[name](spark, FOLDER)
    source = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    key = got.columns[0]
    kept = source if table == "orders" else source.where("text is not null and text <> ''")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in kept.select(key).collect())
    needed = kept.count() / size if table == "orders" else kept.agg(F.sum(F.octet_length("text"))).first()[0] / size
    assert needed > 2
    assert len([f for f in tmp_path.rglob("part-*") if f.is_file()]) >= needed
