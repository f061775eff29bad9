"""Landing to raw and curated: events, card files, transactions, positions, rates, reports.

Inputs are landed files or tables of landed responses; nothing here calls a service.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.dates import parse_date, ts_literal
from siltstone.functions.rules import file_dates, file_group, name_date, overlaps, to_number
from siltstone.functions.text import base_name
from siltstone.operators import stamp as st
from siltstone.operators.conform import conform, drop_present, keep_declared, lower_names
from siltstone.operators.joins import skew_join, work_list
from siltstone.operators.keys import dedup_newest
from siltstone.operators.nested import flatten, flatten_columns, props
from siltstone.operators.profile import infer_schema, run_summary
from siltstone.operators.sets import id_diff, new_items
from siltstone.sources.readers import list_files, read_table
from siltstone.sources.split_scan import read_csv_by_name
from siltstone.sources.writers import compact

# ---------------------------------------------------------------- events

# Properties that events carry in their bag.
EVENT_PROPERTIES = ("brandId", "type", "marketingId")


def curated_events(
    events: DataFrame,
    day: dt.date | Column | None,
    columns: Sequence[str],
    properties: Sequence[str] = EVENT_PROPERTIES,
) -> DataFrame:
    """Select, add year/month/day, coerce the market code, pull properties out of the bag.

    ``columns`` lists all columns of the curated table; those that the export lacks are left out.
    """
    rows = keep_declared(events, columns)
    if day is not None:
        rows = st.date_parts(rows, day if isinstance(day, Column) else F.lit(day))
    if "dma" in rows.columns:
        rows = rows.withColumn("dma", to_number(F.col("dma")))
    if "os_version" in rows.columns:
        rows = rows.withColumn("os_version", F.col("os_version").cast("string"))
    return props(rows, "event_properties", properties) if "event_properties" in rows.columns else rows


# ---------------------------------------------------------------- card files

# Marker in the file name of each card file group.
CARD_GROUPS = {"_fees_": "fees", "_interchange_": "interchange", "_presentments_": "presentments"}
FILE_KEY = "file_key"
SOURCE_FILE = "source_file"


def backfill_plan(
    files: DataFrame,
    done: DataFrame,
    low: dt.date | None = None,
    high: dt.date | None = None,
    groups: Mapping[str, str] = CARD_GROUPS,
) -> DataFrame:
    """Decide for every file (``path``): copied, exists, no group, undated or out of range.

    ``done`` lists the ``path`` of files handled before.
    """
    name = base_name(F.col("path"))
    first, last = file_dates(name)
    dated = files.select("path", name.alias("filename")).withColumns(
        {"first_day": first, "last_day": last, "file_group": file_group(F.col("filename"), groups)}
    )
    known = done.select("path").distinct().withColumn("__done", F.lit(True))
    marked = dated.join(known, "path", "left")  # paths are unique on both sides
    ranged = low is not None or high is not None
    outcome = (
        F.when(F.lit(ranged) & F.col("first_day").isNull(), "undated")
        .when(~overlaps(F.col("first_day"), F.col("last_day"), low, high), "out of range")
        .when(F.col("file_group").isNull(), "no group")
        .when(F.col("__done"), "exists")
        .otherwise("copied")
    )
    return marked.withColumn("outcome", outcome).drop("__done")


def backfill_summary(plan: DataFrame) -> DataFrame:
    """One row: processed, copied and skipped files."""
    outcome = F.col("outcome")
    return plan.agg(
        F.count_if(outcome.isin("copied", "exists", "no group")).alias("processed"),
        F.count_if(outcome == "copied").alias("copied"),
        F.count_if(outcome.isin("exists", "no group", "undated")).alias("skipped"),
    )


def load_card_files(
    spark: SparkSession,
    folder: str,
    manifest: DataFrame,
    schemas: Mapping[str, Mapping[str, str]],
    groups: Mapping[str, str] = CARD_GROUPS,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """New CSV files to one frame per group, and the paths they came from.

    Columns are matched by name without case, ordered by the group schema, tagged with the source
    file; columns outside the schema are dropped. Headers and records come out of one read, in byte
    ranges: a large file is many tasks, many small ones share a task. ``file_key`` tells files of one name
    in different folders apart. File names (not rows) pass the driver, as in any read.
    """
    found = new_items(list_files(spark, folder, "*.csv").select("path"), manifest, "path")
    grouped = found.withColumn("file_group", file_group(base_name(F.col("path")), groups))
    todo = grouped.where(F.col("file_group").isin(*schemas))
    out: dict[str, DataFrame] = {}
    for group in schemas:
        paths = [r["path"] for r in todo.where(F.col("file_group") == group).orderBy("path").collect()]
        if not paths:
            continue
        rows = read_csv_by_name(spark, paths, [c for c in schemas[group] if c != SOURCE_FILE], "__file")
        name = F.url_decode(F.replace(F.substring_index("__file", "/", -1), F.lit("+"), F.lit("%2B")))
        tagged = rows.withColumn(SOURCE_FILE, name).withColumn(FILE_KEY, F.sha1("__file")).drop("__file")
        out[group] = conform(
            tagged.select(*[F.col(f"`{c}`") for c in schemas[group]], FILE_KEY), {**schemas[group], FILE_KEY: "string"}, fill_missing=False
        )
    return out, todo.select("path")


# ---------------------------------------------------------------- transactions, children

# Document columns of the transaction feed and their fields.
TRANSACTION_DOCUMENTS = {
    "amount": "instructedAmount double, currency string",
    "counterpartAccount": (
        "identification struct<iban: string, accountName: string, sortCode: string, "
        "accountNumber: string, reference: string, "
        "other: struct<identification: string, schemeName: struct<code: string>>>"
    ),
    "ultimateRemitterAccount": "id string, iban string",
    "ultimateBeneficiaryAccount": "id string, iban string",
}


def raw_transactions(
    pages: DataFrame,
    schema: Mapping[str, str],
    as_of: dt.date,
    extracted_at: dt.datetime,
    documents: Mapping[str, str | None] = TRANSACTION_DOCUMENTS,
) -> DataFrame:
    """Flatten document columns row by row, stamp, and align to the declared columns."""
    flat = drop_present(flatten_columns(pages, documents), "date", "timestamp_extracted")
    stamped = st.stamp(flat, as_of, extracted_at, st.DASHED_DAY)
    return conform(stamped, schema, fill_missing=False)


def changed_children(
    today: DataFrame, yesterday: DataFrame, children: DataFrame, key: str, parent: str
) -> DataFrame:
    """Child records of the parents that appeared or disappeared between two days."""
    ids = id_diff(today, yesterday, key, labelled=False).withColumnRenamed(key, parent)
    return skew_join(children, ids, [parent], "inner")


# ---------------------------------------------------------------- positions

def positions(
    responses: DataFrame,
    portfolios: DataFrame,
    first: dt.date,
    last: dt.date,
    extracted_at: dt.datetime,
) -> tuple[DataFrame, DataFrame]:
    """Landed responses per portfolio and day to (rows, outcome per unit).

    ``responses``: ``portfolio_id, request_date date, records array<struct<date,
    dateAsString, ...>>``. A requested unit without a response counts as failed.
    """
    units = work_list(portfolios.select("portfolio_id").distinct(), first, last, "request_date")
    answered = responses.where(F.col("records").isNotNull())
    rows = answered.select("portfolio_id", F.explode("records").alias("r")).select("portfolio_id", "r.*")
    stamped = st.swap_date(rows).withColumn("timestamp_extracted", ts_literal(extracted_at))
    sizes = answered.groupBy("portfolio_id", "request_date").agg(
        F.sum(F.size("records")).alias("n_records")
    )
    seen = units.join(sizes, ["portfolio_id", "request_date"], "left")
    summary = run_summary(seen, ["portfolio_id"], F.col("n_records").isNotNull(), F.col("n_records"))
    return stamped, summary


# ---------------------------------------------------------------- rates

def rate_row(
    rates: DataFrame, pairs: Sequence[str], as_of: dt.date, extracted_at: dt.datetime, url: str
) -> DataFrame:
    """One row per ``asked_at`` with one column per currency pair, typed and stamped."""
    cells = [F.min(F.when(F.col("pair") == p, F.col("rate"))).alias(p) for p in pairs]
    wide = rates.groupBy("asked_at").agg(*cells)
    table = f"rates_{url.rstrip('/').split('/')[-1]}"
    return st.stamp(
        wide, as_of, extracted_at,
        record_format="application/json", extract_url=url, table_name=table,
    )


def typed_records(
    pages: DataFrame, records: str, as_of: dt.date, extracted_at: dt.datetime, url: str
) -> DataFrame:
    """Records of landed pages, flattened, typed by whole-column truth and stamped."""
    rows = flatten(pages.select(F.explode(records).alias("r")).select("r.*"))
    typed = conform(rows, infer_schema(rows, "numbers"))
    return st.stamp(
        typed, as_of, extracted_at,
        record_format="application/json", extract_url=url,
        table_name=f"feed_{url.rstrip('/').split('/')[-1]}",
    )


# ---------------------------------------------------------------- report files

def report_files(
    spark: SparkSession, folder: str, report: str, first: dt.date, last: dt.date
) -> list[str]:
    """Paths of one report within a day range, by the date in the file name."""
    files = list_files(spark, folder, f"{report}_*.json")
    day = name_date(F.col("path"))
    wanted = files.where(day.between(first.strftime("%Y%m%d"), last.strftime("%Y%m%d")))
    return [r["path"] for r in wanted.select("path").orderBy("path").collect()]


def load_report(
    spark: SparkSession, paths: Sequence[str], extracted_at: dt.datetime
) -> DataFrame:
    """JSON-array report files to typed rows, dated by their file name.

    The columns of all files are typed together, so one table has one schema.
    """
    raw = read_table(spark, list(paths), "json-array", prefersDecimal="false")
    dated = raw.withColumn("__file_day", name_date(F.col("_metadata.file_name")))
    rows = lower_names(dated)
    schema = infer_schema(rows.drop("__file_day"), "dates")
    out: list[Column] = []
    for name in rows.columns:
        if name in ("__file_day", "date", "timestamp_extracted"):
            continue
        col = F.col(f"`{name}`")
        is_text = dict(rows.dtypes)[name] == "string"
        out.append((parse_date(col) if schema[name] == "date" and is_text else col).alias(name))
    return rows.select(
        *out,
        F.col("__file_day").alias("date"),
        ts_literal(extracted_at).alias("timestamp_extracted"),
    )


# ---------------------------------------------------------------- compaction

def compact_balances(
    balances: DataFrame, target: str, ts: str = "timestamp_extracted", day: str = "date"
) -> None:
    """Drop exact repeats (newest extraction kept) and rewrite to large files by day."""
    compact(dedup_newest(balances, ts), target, [day])
