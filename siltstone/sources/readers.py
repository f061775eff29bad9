"""Scans of landed files, catalog tables, SQL text and earlier snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How each delivered format is read. gzip is recognised by the file extension. JSON array files and
# CSV files, whose quoted values may hold line breaks, are one task per file: deliver many files.
# Parquet footers are not merged: pass mergeSchema="true" for a table whose columns have changed.
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "csv": ("csv", {"header": "true", "escape": "\\", "multiLine": "true"}),
    "parquet": ("parquet", {}),
    "json": ("json", {}),
    "json.gz": ("json", {"pathGlobFilter": "*.json.gz"}),
    "json-array": ("json", {"multiLine": "true"}),
}


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    where: Column | None = None,
    **options: str,
) -> DataFrame:
    """Read by format name; ``where`` on a partition column prunes the listing."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format: {fmt}")
    source, defaults = FORMATS[fmt]
    reader = spark.read.format(source).options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if where is None else df.where(where)


def read_sql(
    spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """SQL text over catalog tables and the given frames, referred to as ``{name}``."""
    return spark.sql(text, **(views or {}))


def list_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names of a catalog table or view; metadata only."""
    return [c.name for c in spark.catalog.listColumns(table)]


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """File manifest (path, length, modificationTime); file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The output of an earlier run with a declared schema; no rows when there was none."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_partition(
    spark: SparkSession, path: str, day: str, column: str = "date"
) -> DataFrame:
    """One day of a partitioned table."""
    return spark.read.parquet(path).where(F.col(column) == day)
