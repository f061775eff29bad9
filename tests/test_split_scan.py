"""Splittable scans against whole-file parsers."""

import csv
import json
import random

import pytest
from pyspark.sql import types as T

from siltstone.session import work_path
from siltstone.sources import split_scan

ID, TEXT = T.StructField("id", T.LongType()), T.StructField("text", T.StringType())
B = T.StructType([T.StructField("b", T.StringType())])
MORE = T.StructType([T.StructField("a", T.ArrayType(B)), T.StructField("c", T.StringType())])
SCHEMA = T.StructType([ID, TEXT, T.StructField("more", MORE)])
BITS = ['"', "\\", "{", "}", "[", "]", ",", "\n", "\r\n", "x", "é", " ", '"}', "},{", '\\"', "\\\\"]


def objects(seed, n=400):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices(BITS, k=rng.randint(0, 12)))
    return [
        {"id": i, "text": text(), "more": rng.choice([None, {"a": [{"b": text()} for _ in range(rng.randint(0, 3))], "c": text()}])}
        for i in range(n)
    ]


def written(spark, tmp_path, *contents):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, content in enumerate(contents):
        (folder / f"part-{i}").write_bytes(content.encode())
    return str(folder)


def as_dicts(df):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    assert not [r for r in rows if r.pop("_corrupt_record")]
    return sorted(rows, key=lambda r: r["id"])


@pytest.mark.parametrize("tasks", [1, 7, 60, 900])
@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays_equal_a_whole_parse_at_any_split(spark, tmp_path, tasks, indent):
    first, second = objects(1), objects(2)
    for r in second:
        r["id"] += 1000
    path = written(spark, tmp_path, json.dumps(first, indent=indent, ensure_ascii=False), " \n" + json.dumps(second) + "\n", "[]", "")
    got = as_dicts(split_scan.read_json_array(spark, path, SCHEMA, min_tasks=tasks))
    assert got == first + second


def test_one_long_object_spans_ranges(spark, tmp_path):
    rows = [{"id": 0, "text": "a"}, {"id": 1, "text": '{"' * 4000, "more": {"a": [{"b": "}"}] * 500, "c": None}}, {"id": 2, "text": "z"}]
    path = written(spark, tmp_path, json.dumps(rows))
    got = as_dicts(split_scan.read_json_array(spark, path, SCHEMA, min_tasks=40))
    assert [(r["id"], r["text"]) for r in got] == [(r["id"], r["text"]) for r in rows]
    assert got[1]["more"] == rows[1]["more"]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_blocks_inside_a_range_give_the_same_records(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(split_scan, "_BLOCK_BITS", bits)
    rows = objects(5, 120)
    path = written(spark, tmp_path, json.dumps(rows, indent=1), json.dumps([]))
    sizes = split_scan.fragments(spark, path, "}", True).groupBy("__file", "__range").count()
    assert max(r["count"] for r in sizes.collect()) <= 2**bits
    assert as_dicts(split_scan.read_json_array(spark, path, SCHEMA)) == rows
    lines = written(spark, tmp_path / "in", 'a,b\n1,"x\n\n,""y"\n2,\n\n3,"\n"\n', "a,b\r\n4,z")
    df = split_scan.read_csv_by_name(spark, lines, ["A", "b"], "file", options={"escape": '"'})
    assert sorted((r["A"], r["b"] or "") for r in df.collect()) == [("1", 'x\n\n,"y'), ("2", ""), ("3", "\n"), ("4", "z")]


@pytest.mark.parametrize("braces", [False, True])
def test_text_is_dealt_once_and_without_its_file(spark, tmp_path, braces):
    path = written(spark, tmp_path, json.dumps(objects(6, 50)))
    pieces = split_scan._pieces(spark, path, "}", braces)
    ranges = split_scan.composed(split_scan.fragments(spark, path, "}", braces)).localCheckpoint()
    plan = split_scan._parts(pieces, ranges, "}", braces)._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.split("\n") if "RepartitionByExpression" in line]
    assert len(dealt) == 1 and "__block" in dealt[0]


def test_what_is_no_object_is_reported(spark, tmp_path):
    path = written(spark, tmp_path, '[{"id": 1}, 5, {"id": 2}, {"id": "x"}]')
    rows = split_scan.read_json_array(spark, path, T.StructType([ID])).collect()
    assert sorted(r["id"] for r in rows if r["id"] is not None) == [1]
    assert len([r for r in rows if r["_corrupt_record"]]) == 2


@pytest.mark.parametrize("tasks", [1, 9, 300])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_equals_a_whole_parse_at_any_split(spark, tmp_path, tasks, end):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(['"', ",", "\n", "x", "é", " y", ";"], k=rng.randint(1, 12)))) for i in range(500)]
    target = tmp_path / "in.csv"
    with target.open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_NONNUMERIC)
        writer.writerow(["id", "text"])
        writer.writerows(rows)
    schema = T.StructType([ID, TEXT])
    how = {"escape": '"'}
    got = sorted((r["id"], r["text"]) for r in split_scan.read_csv(spark, str(target), schema, min_tasks=tasks, options=how).collect())
    assert got == rows


def test_csv_headers_are_checked(spark, tmp_path):
    path = written(spark, tmp_path, "id,text\n1,a\n\n2,b", "id,text\n3,c\n")
    schema = T.StructType([ID, TEXT])
    assert sorted(r["id"] for r in split_scan.read_csv(spark, path, schema).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="declared columns"):
        split_scan.read_csv(spark, path, T.StructType([ID, T.StructField("other", T.StringType())])).collect()


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = written(spark, tmp_path, json.dumps(objects(3, 3000)))
    with split_scan._at_least(spark, 16):
        read = split_scan.fragments(spark, path, "}", True).select("__file", "__range").distinct()
        assert read.count() >= 8
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "0"
    rows = split_scan.records(spark, path, "}", True, 16)
    assert rows.count() == 3001  # and what follows the last object
    assert work_path(spark, "x")


@pytest.mark.parametrize("tasks", [1, 50])
def test_csv_columns_are_found_by_name_in_every_file(spark, tmp_path, tasks):
    path = written(spark, tmp_path, 'A,b\n1,"x\n,y"\n2,\n', 'B,"junk, more",a\r\n"q",z,3\r\n', "b\nonly\n", "a\n")
    df = split_scan.read_csv_by_name(spark, path, ["a", "b", "gone"], "file", tasks)
    rows = sorted(((r["a"] or "", r["b"] or "", r["gone"], r["file"][-1]) for r in df.collect()))
    assert rows == [("", "only", None, "2"), ("1", "x\n,y", None, "0"), ("2", "", None, "0"), ("3", "q", None, "1")]
