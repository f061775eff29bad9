"""Conditional, null-handling, money and file-name expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import base_name


def decide(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered decision table: the value of the first condition that holds."""
    out: Column | None = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(default)


def populated(col: Column) -> Column:
    """1 when the text is neither null nor blank, else 0."""
    return F.when(F.trim(col) != "", 1).otherwise(0)


def yes_no(col: Column, invert: bool = False) -> Column:
    """Boolean or boolean text to Y/N; other text passes through."""
    text = col.cast("string")
    true, false = ("N", "Y") if invert else ("Y", "N")
    return (
        F.when(F.lower(text).contains("false"), false)
        .when(F.lower(text).contains("true"), true)
        .otherwise(text)
    )


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def blank_to(col: Column, default: str = "UNKNOWN") -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def or_default(col: Column, default: object) -> Column:
    return F.coalesce(col, F.lit(default))


def to_number(col: Column, type_name: str = "double", on_bad: str = "null") -> Column:
    """Numeric coercion; unparseable input is null, or 0 with ``on_bad='zero'``."""
    number = col.try_cast(type_name)
    return F.coalesce(number, F.lit(0).cast(type_name)) if on_bad == "zero" else number


# Report-currency rates (base currency unchanged).
REPORT_RATES = {"GBP": Decimal("1"), "USD": Decimal("0.78")}


def convert(
    amount: Column, currency: Column, rates: Mapping[str, Decimal] = REPORT_RATES
) -> Column:
    """Exact fixed-rate conversion; currencies without a rate give null."""
    exact = amount.cast("decimal(20,2)")
    rules = []
    for code, rate in rates.items():
        converted = exact if rate == 1 else exact * F.lit(rate)
        rules.append((currency == code, converted.cast("decimal(23,4)")))
    return decide(rules)


def row_key(*cols: Column) -> Column:
    """Repeatable row id: SHA-256 over the natural key, null and empty kept apart."""
    parts = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def overlaps(
    start: Column,
    end: Column,
    low: dt.date | None = None,
    high: dt.date | None = None,
    keep_undated: bool | None = None,
) -> Column:
    """Closed-interval overlap with an optionally open request window.

    Undated rows are kept only when no bound is given, unless ``keep_undated`` says so.
    """
    if keep_undated is None:
        keep_undated = low is None and high is None
    cond = F.lit(True)
    if low is not None:
        cond = cond & (end >= F.lit(low))
    if high is not None:
        cond = cond & (start <= F.lit(high))
    undated = start.isNull() | end.isNull()
    return F.when(undated, F.lit(keep_undated)).otherwise(cond)


# Fixed value: one date or a date range inside a file name.
FILE_DATE_PATTERN = r"_(\d{8})(?:_to_(\d{8}))?"


def file_dates(name: Column) -> tuple[Column, Column]:
    """First and last day named by a file; both null when absent or invalid."""
    first_text = F.regexp_extract(name, FILE_DATE_PATTERN, 1)
    last_text = F.regexp_extract(name, FILE_DATE_PATTERN, 2)
    first = _compact_date(first_text)
    last = F.when(last_text == "", first).otherwise(_compact_date(last_text))
    valid = first.isNotNull() & last.isNotNull()
    return F.when(valid, first), F.when(valid, last)


def name_date(name: Column) -> Column:
    """Day of names shaped ``<report>_<yyyymmdd...>.<ext>``, as text."""
    return F.substring(F.try_element_at(F.split(base_name(name), "_"), F.lit(2)), 1, 8)


def file_group(name: Column, groups: Mapping[str, str]) -> Column:
    """Group whose marker occurs in the name, ignoring case; null when none does."""
    lowered = F.lower(name)
    return decide([(lowered.contains(mark.lower()), group) for mark, group in groups.items()])


def route(path: Column, targets: Mapping[str, str], default: str | None = None) -> Column:
    """Target chosen by the first path segment."""
    head = F.substring_index(path, "/", 1)
    return decide([(head == segment, target) for segment, target in targets.items()], default)


def _compact_date(text: Column) -> Column:
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd")).cast("date")
