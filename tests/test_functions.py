import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.functions import dates, rules, text
from siltstone.operators import conform as c
from siltstone.operators import profile
from siltstone.operators.nested import parse_map
from siltstone.plans.funnel import bucket


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value,expected",
    [("مرحبا", True), ("hello مرحبا", True), ("مرحبا hello", True), ("مرحبا 123", True),
     ("مَرْحَبًا", True), ("hello", False), ("123", False), ("", False)],
)
def test_arabic_script(spark, value, expected):
    assert one(spark, text.has_script, value) is expected


@pytest.mark.parametrize(
    "value,expected",
    [("a\nb\rc\td", "a b c d"), ("a    b", "a  b"), ("a \n b", "a  b"), ("", ""), (None, None)],
)
def test_clean_text_is_one_pass(spark, value, expected):
    assert one(spark, text.clean_text, value) == expected


def test_clean_nested_keeps_nulls(spark):
    df = spark.createDataFrame([([("x\ny", 1)], None), (None, ("a\tb", 2))], "l array<struct<s:string,n:int>>, r struct<s:string,n:int>")
    cleaned = df.select(*[text.clean_nested(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
    assert [tuple(r) for r in cleaned.collect()] == [([("x y", 1)], None), (None, ("a b", 2))]


@pytest.mark.parametrize(
    "value,expected",
    [("AAA_Fees_BBB.csv", "fees"), ("x_INTERCHANGE_y.csv", "interchange"),
     ("z_presentments_q.csv", "presentments"), ("random.csv", None)],
)
def test_file_group(spark, value, expected):
    groups = {"_fees_": "fees", "_interchange_": "interchange", "_presentments_": "presentments"}
    assert one(spark, lambda v: rules.file_group(v, groups), value) == expected


D = dt.date


@pytest.mark.parametrize(
    "value,first,last",
    [("till_20310704.csv", D(2031, 7, 4), D(2031, 7, 4)),
     ("till_20310704_to_20310802-again.csv", D(2031, 7, 4), D(2031, 8, 2)),
     ("till_summer.csv", None, None), ("till_20310231.csv", None, None),
     ("till_20310704_to_20310732.csv", None, None)],
)
def test_file_dates(spark, value, first, last):
    row = spark.createDataFrame([(value,)], "v string").select(*rules.file_dates(F.col("v"))).first()
    assert tuple(row) == (first, last)


@pytest.mark.parametrize(
    "value,expected",
    [("{'key': 'value'}", {"key": "value"}), ('{"key": "value"}', {"key": "value"}),
     ("invalid string", None), (None, None), ("{'a': None, 'b': True}", {"a": None, "b": "true"}),
     ("{'a': 'was None, True here', 'b': False}", {"a": "was None, True here", "b": "false"}),
     ("{\"it's\": None}", {"it's": None}), ("{'n': 'None'}", {"n": "None"})],
)
def test_parse_map(spark, value, expected):
    assert one(spark, parse_map, value) == expected


def test_long_document_text_is_parsed_whole(spark):
    body = "{'a': '" + "x" * 200_000 + "', 'b': None}"
    assert len(one(spark, parse_map, body)["a"]) == 200_000


@pytest.mark.parametrize(
    "value,expected",
    [("2024-09-16T03:41:17Z", dt.datetime(2024, 9, 16, 3, 41, 17)),
     ("2024-09-16T03:41:17.5+0100", dt.datetime(2024, 9, 16, 2, 41, 17, 500000)),
     ("2024-09-16", dt.datetime(2024, 9, 16)),
     ("202409090450", dt.datetime(2024, 9, 9, 4, 50)),
     ("Sep 16, 2024, 03:41:17 AM", dt.datetime(2024, 9, 16, 3, 41, 17)),
     ("7/30/2024 6:27:00 PM", dt.datetime(2024, 7, 30, 18, 27)),
     ("2024-07-30 18:27:00", dt.datetime(2024, 7, 30, 18, 27)),
     ("30-07-2024 18:27:00", dt.datetime(2024, 7, 30, 18, 27)),
     ("nonsense", None), ("31/31/2024", None), (None, None)],
)
def test_parse_ts(spark, value, expected):
    assert one(spark, lambda v: dates.parse_ts(v).cast("timestamp_ntz"), value) == expected


def test_parse_ts_can_raise(spark):
    with pytest.raises(PySparkException, match="unparseable"):
        one(spark, lambda v: dates.parse_ts(v, on_bad="raise"), "nonsense")


@pytest.mark.parametrize(
    "born,as_of,years",
    [(D(2000, 6, 15), D(2023, 6, 14), 22), (D(2000, 6, 15), D(2023, 6, 15), 23),
     (D(2000, 2, 29), D(2001, 2, 28), 1), (D(2000, 2, 29), D(2001, 2, 27), 0), (None, D(2020, 1, 1), None)],
)
def test_age_years(spark, born, as_of, years):
    assert one(spark, lambda v: dates.age_years(v, as_of), born, "date") == years


@pytest.mark.parametrize("age,label", [(15, None), (16, "16"), (17, "17_to_23"), (30, "24_to_30"), (31, "31_to_45"), (46, "46+"), (None, None)])
def test_bands(spark, age, label):
    assert one(spark, lambda v: dates.band(v, dates.AGE_BANDS_FROM_16), age, "int") == label


def test_whole_weeks_truncate_by_the_hour(spark):
    start = dt.datetime(2024, 1, 1, 12)
    week = lambda end: one(spark, lambda v: dates.whole_weeks(v, end), start, "timestamp_ntz")
    assert week(dt.datetime(2024, 1, 22, 11, 59)) == 2
    assert week(dt.datetime(2024, 1, 22, 12)) == 3


def test_date_span():
    assert dates.date_span("20240101", "20240103", D(2024, 5, 5)) == (D(2024, 1, 1), D(2024, 1, 3))
    assert dates.date_span(None, None, D(2024, 5, 5)) == (D(2024, 5, 4), D(2024, 5, 4))
    for start, end in (("2024-1-1", "20240103"), ("20240105", "20240103"), ("20230229", "20230301"), ("x", "20240101")):
        with pytest.raises(ValueError):
            dates.date_span(start, end, D(2024, 5, 5))


def test_snake_case(spark):
    df = spark.createDataFrame([("a", "b")], "FirstName string, lastNAME string")
    assert c.snake_case(df).columns == ["first_name", "last_name"]


def test_renaming_collisions_are_refused(spark):
    df = spark.createDataFrame([("a", "b")], "`A` string, `b` string").toDF("x", "X")
    with pytest.raises(ValueError, match="collide"):
        c.lower_names(df)
    with pytest.raises(ValueError, match="2 columns"):
        c.rename_positional(df, ["only"])


@pytest.mark.parametrize(
    "idv,address,status,expected",
    [("PASSED", "AWAITING_MANUAL_REVIEW", "X", "[Complete IDV, Awaiting Address Review]"),
     ("PASSED", "AWAITING_DOCUMENT_UPLOAD", None, "[Complete IDV, Don't Complete POA]"),
     ("PASSED", "VERIFIED", "AWAITING_SUBMISSION", "[Complete IDV, POA - Don't Submit]"),
     ("PASSED", "VERIFIED", "AWAITING_ADDITIONAL_DOCUMENTS", "[Submit Application, Don't Submit EDD Docs]"),
     ("PASSED", "VERIFIED", "AWAITING_MANUAL_REVIEW", "[Submitted EDD Docs]"),
     ("PASSED", "VERIFIED", "OTHER", None),
     ("AWAITING_CUSTOMER_RETRY", "AWAITING_MANUAL_REVIEW", "AWAITING_MANUAL_REVIEW", "[IDV incomplete, Awaiting Address Review]"),
     ("AWAITING_CUSTOMER_RETRY", "AWAITING_MANUAL_REVIEW", "OTHER", "[IDV incomplete, POA incomplete]"),
     ("PENDING", "VERIFIED", None, "[IDV Incomplete, POA Complete]"),
     ("UNKNOWN", "AWAITING_PROVIDER_SELECTION", "AWAITING_SUBMISSION", "[Don't start IDV, POA]"),
     ("UNKNOWN", "AWAITING_PROVIDER_SELECTION", "OTHER", None),
     ("UNKNOWN", "VERIFIED", None, "[IDV Not Started, POA Complete]"), (None, "VERIFIED", None, None)],
)
def test_bucket(spark, idv, address, status, expected):
    df = spark.createDataFrame([(idv, address, status)], "i string, a string, s string")
    assert df.select(bucket(F.col("i"), F.col("a"), F.col("s"))).first()[0] == expected


def test_row_key_keeps_null_and_parts_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a_", "b"), ("a", "_b")], "x string, y string")
    keys = [r[0] for r in df.select(rules.row_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 4


def test_conform_reads_every_layout_that_inference_accepts(spark):
    texts = [("15/03/2024",), ("15-3-2024",), ("2024-03-15",), ("20240315",), ("Mar 15, 2024, 12:00:00 AM",)]
    df = spark.createDataFrame(texts, "made string")
    schema = profile.infer_schema(df)
    assert schema == {"made": "date"}
    assert {r[0] for r in c.conform(df, schema).collect()} == {D(2024, 3, 15)}


def test_conform_can_raise(spark):
    df = spark.createDataFrame([("x",), (None,)], "n string")
    with pytest.raises(PySparkException, match="not int"):
        c.conform(df, {"n": "int"}, on_bad="raise").collect()


def test_conform_null_stays_null_and_bad_values_do_not_fail(spark):
    df = spark.createDataFrame([("12.5", None, "2024-01-01"), ("x", "t", "bad")], "n string, s string, d string")
    out = c.conform(df, {"s": "string", "n": "int", "d": "date", "extra": "timestamp"})
    assert out.columns == ["s", "n", "d", "extra"]
    assert [tuple(r) for r in out.collect()] == [(None, None, D(2024, 1, 1), None), ("t", None, None, None)]
