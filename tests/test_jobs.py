import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from siltstone import jobs
from siltstone.plans.funnel import REPORT_COLUMNS
from siltstone.sources import readers, writers
from tests.test_tables import SCHEMAS, land

LOG = """key_id string, alt_key_id string, updated_at timestamp_ntz, status string, date_of_birth string,
gender string, phone string, email string, nickname string, first_name string, last_name string,
brand_id string, address_country string, address_status string, idv_status string, pep_passed string"""


def entry(user, when, status, address="VERIFIED", idv="PASSED", country="ARE", alt=False):
    key = (None, user) if alt else (user, None)
    return (*key, when, status, "2000-01-01", "Female", "1", "e", "n", "f", "l", "b", country, address, idv, "True")


def test_card_load_twice(spark, tmp_path):
    folder, lake = tmp_path / "in", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "x_Fees_1.csv").write_text("Card,FEE\nc1,1.5\n")
    assert jobs.run_card_load(spark, str(folder), lake, SCHEMAS)["processed_count"] == 1
    assert jobs.run_card_load(spark, str(folder), lake, SCHEMAS)["processed_count"] == 0
    (folder / "x_Fees_2.csv").write_text("FEE,Card\n2.5,c2\n")
    assert jobs.run_card_load(spark, str(folder), lake, SCHEMAS)["processed_count"] == 1
    table = readers.read_table(spark, f"{lake}/card_fees", "csv", "card string, fee double, source_file string")
    assert sorted(tuple(r)[:2] for r in table.collect()) == [("c1", 1.5), ("c2", 2.5)]


def test_funnel_over_three_days(spark, tmp_path):
    lake = str(tmp_path)
    day = lambda n: dt.datetime(2024, 1, n, 9)
    history = [
        entry("u1", day(1), "AWAITING_SUBMISSION"),
        entry("u2", day(1), "X", "AWAITING_QR_SCAN", alt=True),
        entry("u3", day(1), "APPROVED"),
        entry("u4", day(1), "X", country="GBR"),
        entry("old", dt.datetime(2023, 1, 1), "X", "AWAITING_QR_SCAN"),
    ]
    forms = spark.createDataFrame([("u1", day(1), "SELF_EMPLOYED")], "customer_id string, updated_at timestamp_ntz, c0 string")
    reworks = spark.createDataFrame([("u2",), ("u2",)], "user_id string")

    def run(n):
        log = spark.createDataFrame(history, LOG)
        path = jobs.run_funnel(log, reworks, forms, ["c0"], lake, day(n))
        rows = spark.read.parquet(f"{lake}/funnel_snapshots").where(F.col("date") == f"202401{n:02d}")
        assert spark.read.option("header", True).csv(path).count() == rows.count()
        assert set(rows.columns) == {*REPORT_COLUMNS, "date"}
        return {r["user_id"]: r for r in rows.collect()}

    first = run(2)
    assert set(first) == {"u1", "u2"}  # approved, foreign and early users are not added
    assert first["u1"]["original_bucket"] == "[Complete IDV, POA - Don't Submit]"
    assert first["u1"]["self_employed"] == "Y" and first["u2"]["rework"] == "Y" and first["u1"]["rework"] == " "
    history.append(entry("u1", day(3), "APPROVED"))
    second = run(3)
    assert second == run(3)  # a repeated day gives the same snapshot
    assert second["u1"]["latest_bucket"] == "APPROVED" and second["u1"]["onboarded"] == "Y"
    assert second["u1"]["moved"] == "Y" or second["u1"]["original_bucket"] == first["u1"]["original_bucket"]
    assert second["u2"]["moved"] == "N" and second["u2"]["onboarded"] == "N"
    assert second["u2"]["weeks_waiting"] is None
    for n in range(4, 24):
        last = run(n) if n in (4, 23) else None
        if n == 4:
            assert set(last) == {"u1", "u2"}
    assert last["u2"]["weeks_waiting"] == "3 weeks or more"


def test_event_stream_job(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    land(landing, "a.json.gz", [
        {"user_id": "1", "event_type": "x", "dma": "101", "event_properties": '{"brandId": "b"}', "other": 1},
        {"user_id": "2", "event_type": "x", "dma": "bad", "event_properties": None},
        {"event_type": "no user"},
    ])
    schema = "user_id string, event_type string, dma string, event_properties string"
    (landing / "b.json").write_text("")
    with gzip.open(landing / "c.json.gz", "wt") as f:
        f.write('{"user_id": "3", \n')
    columns = ["user_id", "event_type", "dma", "event_properties"]
    for _ in range(2):
        jobs.run_event_stream(
            spark, str(landing), schema, lake, dt.date(2024, 5, 2), columns, rules={"user": F.col("user_id").isNotNull()}
        )
    rows = spark.read.parquet(f"{lake}/events_curated").orderBy("user_id").select("user_id", "dma", "brandId", "type", "month")
    assert [tuple(r) for r in rows.collect()] == [("1", 101.0, "b", "", "05"), ("2", None, "", "", "05")]
    bad = {r["failed_rules"]: r for r in spark.read.parquet(f"{lake}/events_quarantine").collect()}
    assert set(bad) == {"user", "readable,user"}
    broken = bad["readable,user"]
    assert broken["_broken_record"].startswith('{"user_id": "3"') and broken["_record_file"].endswith("c.json.gz")


def test_report_load_replaces_its_days(spark, tmp_path):
    folder, lake = tmp_path / "in", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "Balance_202401010730.json").write_text(json.dumps([{"Id": 1}, {"Id": 2}]))
    args = (spark, str(folder), "Balance", lake, dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    assert jobs.run_report_load(*args) == 1 and jobs.run_report_load(*args) == 1
    assert spark.read.parquet(f"{lake}/report_balance").count() == 2


def test_changed_children_job(spark, tmp_path, rows):
    path = str(tmp_path / "accounts")
    days = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-02")], "id string, date string")
    writers.write_table(days, path, partition_by=["date"])
    children = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 4)], "parent string, n int")
    got = jobs.run_changed_children(spark, path, children, "id", "parent", dt.date(2024, 1, 2))
    rows(got, [("a", 1), ("c", 3), ("c", 4)])


def test_card_load_stopped_before_the_manifest(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "in", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "x_Fees_1.csv").write_text('Card,FEE\n"c\n1",1.5\nc2,2\n')
    write = jobs.write_table

    def stopped(df, path, *args, **kwargs):
        if "processed" in path:
            raise RuntimeError("stopped")
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "write_table", stopped)
    with pytest.raises(RuntimeError):
        jobs.run_card_load(spark, str(folder), lake, SCHEMAS)
    monkeypatch.setattr(jobs, "write_table", write)
    (folder / "x_Fees_2.csv").write_text("Card,FEE\nc3,3\n")
    assert jobs.run_card_load(spark, str(folder), lake, SCHEMAS)["processed_count"] == 2
    table = readers.read_table(spark, f"{lake}/card_fees", "csv")
    assert sorted(r["card"] for r in table.collect()) == ["c\n1", "c2", "c3"]


def test_a_missed_day_keeps_the_funnel(spark, tmp_path):
    lake, day = str(tmp_path), lambda n: dt.datetime(2024, 1, n, 9)
    forms = spark.createDataFrame([], "customer_id string, updated_at timestamp_ntz, c0 string")
    reworks = spark.createDataFrame([], "user_id string")
    history = [entry("u1", day(1), "AWAITING_SUBMISSION")]
    jobs.run_funnel(spark.createDataFrame(history, LOG), reworks, forms, ["c0"], lake, day(2))
    history.append(entry("u1", day(3), "APPROVED"))
    jobs.run_funnel(spark.createDataFrame(history, LOG), reworks, forms, ["c0"], lake, day(5))
    rows = spark.read.parquet(f"{lake}/funnel_snapshots").where("date = '20240105'").collect()
    assert [(r["user_id"], r["onboarded"]) for r in rows] == [("u1", "Y")]
    with pytest.raises(ValueError, match="later"):
        jobs.run_funnel(spark.createDataFrame(history, LOG), reworks, forms, ["c0"], lake, day(1))


def test_positions_keep_other_portfolios_of_the_day(spark, tmp_path):
    kind = "portfolio_id string, request_date date, records array<struct<date:string,dateAsString:string,qty:int>>"
    lake, day, now = str(tmp_path), dt.date(2024, 1, 1), dt.datetime(2024, 1, 2)
    for name, qty in (("p1", 1), ("p2", 2), ("p1", 3)):
        responses = spark.createDataFrame([(name, day, [("01/01/2024", "20240101", qty)])], kind)
        jobs.run_positions(responses, responses, {"qty": "int", "date": "string"}, lake, "held", day, day, now)
    table = spark.read.parquet(f"{lake}/held")
    assert sorted((r["portfolio_id"], r["qty"]) for r in table.collect()) == [("p1", 3), ("p2", 2)]


def test_children_of_a_day_after_a_missed_day(spark, tmp_path, rows):
    path = str(tmp_path / "accounts")
    days = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("b", "2024-01-04"), ("c", "2024-01-04")], "id string, date string")
    writers.write_table(days, path, partition_by=["date"])
    children = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "parent string, n int")
    rows(jobs.run_changed_children(spark, path, children, "id", "parent", dt.date(2024, 1, 4)), [("a", 1), ("c", 3)])
