"""Ingest metadata and partition columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import ts_literal

# The two layouts of the text partition column ``date``.
COMPACT_DAY = "%Y%m%d"
DASHED_DAY = "%Y-%m-%d"


def stamp(
    df: DataFrame,
    as_of: dt.date,
    extracted_at: dt.datetime,
    day_format: str = COMPACT_DAY,
    **constants: str,
) -> DataFrame:
    """Add ``date`` (text), ``timestamp_extracted`` and any constant columns."""
    columns = {
        "date": F.lit(as_of.strftime(day_format)),
        "timestamp_extracted": ts_literal(extracted_at),
    }
    columns.update({name: F.lit(value) for name, value in constants.items()})
    return df.withColumns(columns)


def source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Name of the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def date_parts(df: DataFrame, day: Column, as_text: bool = True) -> DataFrame:
    """Partition columns year, month and day: zero-padded text, or integers."""
    parts = {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    if not as_text:
        parts = {name: part.cast("int") for name, part in parts.items()}
    return df.withColumns(parts)


def date_parts_of_text(df: DataFrame, column: str, sep: str = "-") -> DataFrame:
    """The same columns cut from date text."""
    return df.withColumns(
        {
            name: F.try_element_at(F.split(F.col(column), sep), F.lit(i))
            for i, name in enumerate(("year", "month", "day"), start=1)
        }
    )


def swap_date(df: DataFrame, day: str = "date", text: str = "dateAsString") -> DataFrame:
    """Exchange the raw date and its partition text; both are read before either is set."""
    return df.withColumns({day: F.col(text), text: F.col(day)})


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
