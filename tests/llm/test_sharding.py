from collections import defaultdict

import pytest

from siltstone.llm.sharding import shard, write_shards

KIND = "doc_id long, text string, shard string"


def check(rows, limit):
    held = defaultdict(list)
    for r in rows:
        held[r["shard"]].append(r)
    for name, members in held.items():
        size = sum(r["n_bytes"] for r in members)
        assert size <= limit or len(members) == 1
        assert {(r["shard_bytes"], r["shard_docs"]) for r in members} == {(size, len(members))}
        plain = name.removeprefix("overflow-")
        assert len(plain) == members[0]["depth"]
        # Only oversized buckets split: the parent does not fit.
        if plain and plain == name and not any(r["shard"].startswith("overflow-") for r in rows):
            parent = [r for r in rows if r["shard"].startswith(name[:-1])]
            assert sum(r["n_bytes"] for r in parent) > limit
    plain = [n for n in held if not n.startswith("overflow-")]
    assert not [(a, b) for a in plain for b in plain if a != b and b.startswith(a)]


@pytest.mark.parametrize("limit", [50, 700, 5000, 10**9])
@pytest.mark.parametrize("round_bits", [2, 12])
def test_shards_fit_and_split_only_where_needed(spark, limit, round_bits):
    rows = [(i, "x" * (i % 37), "clash") for i in range(400)] + [(None, "y", None), (1000, None, None), (1001, "z" * 3000, None)]
    got = shard(spark.createDataFrame(rows, KIND), limit=limit, round_bits=round_bits).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    check(got, limit)


def test_a_repeated_key_overflows(spark):
    rows = [(7, "same text", None)] * 300 + [(100 + i, "abc", None) for i in range(50)]
    got = shard(spark.createDataFrame(rows, KIND), limit=100).collect()
    assert len(got) == 350
    check(got, 100)
    assert sum(r["shard"].startswith("overflow-") for r in got) == 300


def test_empty_table_and_files(spark, tmp_path):
    assert shard(spark.createDataFrame([], KIND)).count() == 0
    df = spark.createDataFrame([(i, "x" * 20, None) for i in range(60)], KIND).drop("shard")
    write_shards(df, str(tmp_path / "out"), limit=200)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_null_and_repeated_keys_are_written_once(spark, tmp_path):
    rows = [(7, f"text {i:03}") for i in range(100)] + [(None, "a"), (None, "b"), (8, None), (8, None), (9, "z" * 500)]
    write_shards(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "out"), limit=100)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(rows, key=repr)
    size = defaultdict(list)
    for r in got:
        size[str(r["shard"])].append(len(r["text"] or ""))
    assert all(sum(x) <= 100 or len(x) == 1 for x in size.values())
