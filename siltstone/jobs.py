"""Runnable jobs: read the tables of a lake, build, write. Every run can be repeated.

A lake is a root folder with one sub-folder per table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.conform import keep_declared
from siltstone.plans import ingest
from siltstone.plans.funnel import REPORT_COLUMNS, funnel_report
from siltstone.sources.readers import read_partition, read_snapshot
from siltstone.sources.writers import MAX_ROWS_PER_FILE, replace_units, write_report, write_table
from siltstone.streaming.arrivals import BROKEN, FILE, batch_writer, file_stream, run_available

MANIFEST_SCHEMA = T.StructType([T.StructField("path", T.StringType())])
REPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REPORT_COLUMNS])


def refresh_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    comments: Mapping[str, str] | None = None,
) -> None:
    """Replace the partitions a build produced (all of the table without partitions)."""
    mode = "overwrite_partitions" if partition_by else "overwrite"
    write_table(df, path, mode=mode, partition_by=partition_by, comments=comments)


def run_card_load(
    spark: SparkSession,
    folder: str,
    lake: str,
    schemas: Mapping[str, Mapping[str, str]],
    groups: Mapping[str, str] = ingest.CARD_GROUPS,
) -> dict[str, int]:
    """New card files to one CSV table per group; the manifest grows only after the write.

    Each file owns the partition of its key and replaces it, so a run that stopped before the manifest
    was written can be repeated.
    """
    manifest = f"{lake}/card_files_processed"
    seen = read_snapshot(spark, manifest, MANIFEST_SCHEMA)
    frames, done = ingest.load_card_files(spark, folder, seen, schemas, groups)
    finished = [row["path"] for row in done.collect()]  # file names, fixed for this run
    for group, rows in frames.items():
        write_table(rows, f"{lake}/card_{group}", "csv", mode="overwrite_partitions", partition_by=[ingest.FILE_KEY])
    if finished:
        names = spark.createDataFrame([(p,) for p in finished], MANIFEST_SCHEMA)
        write_table(names, manifest, mode="append")
    return {"processed_count": len(finished), "groups": len(frames)}


def _day_before(history: DataFrame, column: str, today: str) -> str | None:
    """The newest day before today in a table; none in a table without other days."""
    days = history.where(F.col(column) != today).agg(F.max(F.when(F.col(column) < today, F.col(column))), F.count("*")).first()
    if days[0] is None and days[1]:
        raise ValueError(f"all days of the table are later than {today}")
    return days[0]


def run_funnel(
    log: DataFrame,
    reworks: DataFrame,
    forms: DataFrame,
    circumstances: list[str],
    lake: str,
    as_of: dt.datetime,
    **limits,
) -> str:
    """Merge into the newest earlier snapshot, replace today's, write the dated report file.

    Missed days do not matter. Snapshots of later days alone mean a wrong date: the job refuses.
    """
    spark = log.sparkSession
    snapshots = f"{lake}/funnel_snapshots"
    schema = T.StructType([*REPORT_SCHEMA.fields, T.StructField("date", T.StringType())])
    today = as_of.strftime("%Y%m%d")
    history = read_snapshot(spark, snapshots, schema)
    before = _day_before(history, "date", today)
    previous = history.where(F.col("date") == before).select(*REPORT_COLUMNS)
    report = funnel_report(log, reworks, forms, circumstances, previous, as_of, **limits)
    refresh_table(report.withColumn("date", F.lit(today)), snapshots)
    written = read_partition(spark, snapshots, today).select(*REPORT_COLUMNS)
    return write_report(written, f"{lake}/funnel_reports", as_of.date())


def run_changed_children(
    spark: SparkSession, parents: str, children: DataFrame, key: str, parent: str, today: dt.date
) -> DataFrame:
    """Children of the parents that differ between today's partition of a table and the newest before it."""
    day = today.strftime("%Y-%m-%d")
    before = _day_before(spark.read.parquet(parents), "date", day)
    return ingest.changed_children(
        read_partition(spark, parents, day).select(key),
        read_partition(spark, parents, before).select(key),
        children, key, parent,
    )


def run_event_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    lake: str,
    day: dt.date,
    columns: Sequence[str],
    rules: Mapping[str, Column] | None = None,
) -> None:
    """Arrived event files to the curated table, each file once; broken records keep their text in the quarantine."""
    arrived = file_stream(spark, landing, schema, keep_broken=True)
    stream = ingest.curated_events(arrived, day, [*columns, BROKEN, FILE])
    sink = batch_writer(
        f"{lake}/events_curated", ["year", "month", "day"], rules, f"{lake}/events_quarantine"
    )
    run_available(stream, sink, f"{lake}/_checkpoints/events_curated")


def run_report_load(
    spark: SparkSession,
    folder: str,
    report: str,
    lake: str,
    first: dt.date,
    last: dt.date,
    extracted_at: dt.datetime,
) -> int:
    """Report files of a day range to the raw table; returns the number of files."""
    paths = ingest.report_files(spark, folder, report, first, last)
    if paths:
        rows = ingest.load_report(spark, paths, extracted_at)
        refresh_table(rows, f"{lake}/report_{report.lower()}")
    return len(paths)


def run_positions(
    responses: DataFrame,
    portfolios: DataFrame,
    schema: Mapping[str, str],
    lake: str,
    table: str,
    first: dt.date,
    last: dt.date,
    extracted_at: dt.datetime,
) -> DataFrame:
    """Save what arrived, return the outcome per unit; callers decide what partial means.

    A unit is one portfolio and date: a repeated call replaces the units that it brings and no others.
    Portfolios share the hash buckets of their day, so a million of them make no million folders.
    """
    rows, summary = ingest.positions(responses, portfolios, first, last, extracted_at)
    unit = ["date", "portfolio_id"]
    columns = [*schema, *[c for c in unit if c not in schema]]
    replace_units(keep_declared(rows, columns), f"{lake}/{table}", unit)
    return summary


__all__ = [
    "MAX_ROWS_PER_FILE", "refresh_table", "run_card_load", "run_changed_children",
    "run_event_stream", "run_funnel", "run_positions", "run_report_load",
]
