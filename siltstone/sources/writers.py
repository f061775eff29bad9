"""Table and report sinks, quarantine of bad rows, compaction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.schema import with_comments
from siltstone.session import materialize

# Rows per output file and size of compacted files.
MAX_ROWS_PER_FILE = 400_000
TARGET_MB = 127

#: Hash buckets that the units of one partition lie in.
UNIT_BUCKETS = 64
UNIT_BUCKET = "unit_bucket"

WRITE_OPTIONS = {
    "parquet": {"compression": "snappy"},
    "csv": {"header": "true", "escape": "\\"},
    "json": {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"},
}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    max_rows: int = MAX_ROWS_PER_FILE,
    comments: Mapping[str, str] | None = None,
    table: str | None = None,
    balanced: bool = False,
) -> None:
    """Write a table. ``overwrite_partitions`` replaces only the partitions in ``df``.

    ``balanced`` gathers each partition value first (hot ones in several tasks), for rows
    that span many partitions and would give every task a small file in each.
    """
    if fmt not in WRITE_OPTIONS:
        raise ValueError(f"unsupported file format: {fmt}")
    dynamic = mode == "overwrite_partitions"
    out = with_comments(df, comments) if comments else df
    if balanced and partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = (
        out.write.format(fmt)
        .mode("overwrite" if dynamic else mode)
        .options(**WRITE_OPTIONS[fmt])
        .option("maxRecordsPerFile", max_rows)
    )
    if mode.startswith("overwrite"):
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)


def replace_units(
    df: DataFrame, path: str, units: Sequence[str], partition_by: Sequence[str] = ("date",), buckets: int = UNIT_BUCKETS
) -> None:
    """Replace the rows of the units that ``df`` brings (all of a table's rows with their ``units`` values) and no others.

    Units lie in a bounded number of hash buckets inside each partition, however many there are. The touched
    buckets are read, freed of the units that come anew, and written whole; they are prepared beside the
    table first, so a run that stops leaves the table as it was. ``units`` include ``partition_by``.
    """
    spark = df.sparkSession
    if not set(partition_by) <= set(units):
        raise ValueError("units must include the partition columns")
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{u}`").cast("string") for u in units]), F.lit(buckets)).cast("string")
    fresh = materialize(df.withColumn(UNIT_BUCKET, bucket), "units")
    layout = [*partition_by, UNIT_BUCKET]
    merged = fresh
    try:
        table = spark.read.schema(fresh.schema).parquet(path)
        # Days and buckets of this run: a few values, which prune the listing.
        values = {c: [r[0] for r in fresh.select(c).distinct().collect()] for c in layout}
        for c, found in values.items():
            table = table.where(F.col(f"`{c}`").isin([v for v in found if v is not None]) | (F.lit(None in found) & F.col(f"`{c}`").isNull()))
        touched = table.alias("old").join(
            fresh.select(*layout).distinct().alias("new"), reduce(lambda a, b: a & b, [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in layout]), "left_semi"
        )
        again = reduce(lambda a, b: a & b, [F.col(f"old.`{u}`").eqNullSafe(F.col(f"come.`{u}`")) for u in units])
        kept = touched.alias("old").join(fresh.select(*units).distinct().alias("come"), again, "left_anti")
        merged = materialize(kept.select(*[F.col(f"`{c}`") for c in fresh.columns]).unionByName(fresh), "units-merged")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
    write_table(merged, path, mode="overwrite_partitions", partition_by=layout, balanced=True)


def write_with_fallback(
    df: DataFrame, path: str, fallback_path: str, partition_by: Sequence[str] = (), **kwargs
) -> None:
    """Write; on failure keep the same rows as JSON lines, then raise the error."""
    try:
        write_table(df, path, partition_by=partition_by, **kwargs)
    except Exception:
        df.write.mode("append").options(**WRITE_OPTIONS["json"]).json(fallback_path)
        raise


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with the names of the failed rules."""
    failed = F.filter(
        F.array(
            *[
                F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
                for name, rule in rules.items()
            ]
        ),
        lambda x: x.isNotNull(),
    )
    valid = reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules.values()])
    return df.where(valid), df.where(~valid).withColumn("failed_rules", F.concat_ws(",", failed))


def write_report(
    df: DataFrame, root: str, as_of: dt.date, prefix: str = "output", files: int | None = 1
) -> str:
    """A dated CSV folder of ``files`` files; ``None`` leaves the number to the tasks that hold the rows."""
    path = f"{root.rstrip('/')}/{prefix}_{as_of.strftime('%d%m%y')}_EOD"
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").options(**WRITE_OPTIONS["csv"]).csv(path)
    return path


def compact(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = ("date",),
    target_mb: int = TARGET_MB,
) -> None:
    """Rewrite a table into files of about ``target_mb``, hot partitions split.

    ``target`` must not be the folder the rows are read from: a failed run then leaves the
    old table whole. Publish the result with ``swap_location``.
    """
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the table: {missing}")
    spark = df.sparkSession
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, f"{target_mb}m")
    try:
        write_table(
            df, target, mode="overwrite", partition_by=partition_by, max_rows=0, balanced=True
        )
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def swap_location(spark: SparkSession, table: str, path: str) -> None:
    """Point a partitioned catalog table at a newly written folder."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
