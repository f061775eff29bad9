"""A log of versions below a folder: what a run wrote counts from the moment that its entry is there.

Every entry is a small Parquet folder of its own, written last. A run that dies before leaves files that
no entry names; the next run writes the same version anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def entries(spark: SparkSession, root: str) -> DataFrame | None:
    """All entries with their ``version``; None before the first one."""
    try:
        found = spark.read.option("recursiveFileLookup", "false").parquet(f"{root}/log")
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found.withColumn("version", F.col("version").cast("long"))


def latest(spark: SparkSession, root: str) -> int:
    """The newest version, 0 before the first one."""
    found = entries(spark, root)
    return (found.agg(F.max("version")).first()[0] or 0) if found is not None else 0


def version_of(spark: SparkSession, root: str, batch: str) -> int | None:
    """The version that a batch led to, or None if it never did."""
    found = entries(spark, root)
    row = found.where(F.col("batch") == batch).agg(F.max("version")).first() if found is not None else None
    return row[0] if row else None


def publish(rows: DataFrame, root: str, version: int, batch: str) -> None:
    """Make a version the newest, with the rows that describe it."""
    rows.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("overwrite").parquet(f"{root}/log/version={version}")
