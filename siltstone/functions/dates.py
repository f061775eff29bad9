"""Date and time expressions. ``as_of`` is always an argument, never the wall clock."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text layouts a delivered timestamp may have, tried in this order
# after ISO-8601.
TIMESTAMP_FORMATS = (
    "yyyyMMddHHmm",
    "MMM d, yyyy, h:mm:ss a",
    "M/d/yyyy h:mm:ss a",
    "yyyy-MM-dd HH:mm:ss",
    "d-M-yyyy H:mm:ss",
)
# Date layouts of report files, day before month.
DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "yyyyMMdd")


def ts_literal(value: dt.datetime) -> Column:
    """A wall-clock literal that does not depend on the time zone of the driver."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _literal(value: Column | dt.date) -> Column:
    if isinstance(value, dt.datetime):
        return ts_literal(value)
    return value if isinstance(value, Column) else F.lit(value)


def age_years(born: Column, as_of: Column | dt.date) -> Column:
    """Complete years; 29 February counts as complete on 28 February."""
    return (F.months_between(_literal(as_of), born) / 12).cast("int")


def band(value: Column, edges: Sequence[tuple[int, int | None, str]]) -> Column:
    """Label of the first ``(low, high, label)`` that holds the value; ``high`` may be open."""
    out: Column | None = None
    for low, high, label in edges:
        cond = value >= low if high is None else value.between(low, high)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    assert out is not None
    return out


# Age bands of the customer tables.
AGE_BANDS = (
    (17, 23, "17_to_23"),
    (24, 30, "24_to_30"),
    (31, 45, "31_to_45"),
    (46, None, "46+"),
)
AGE_BANDS_FROM_16 = ((16, 16, "16"), *AGE_BANDS)


def whole_weeks(start: Column, end: Column | dt.datetime) -> Column:
    """Whole weeks elapsed, truncated."""
    return F.timestamp_diff("WEEK", start, _literal(end))


def safe_date(col: Column) -> Column:
    return col.try_cast("date")


def _shape(fmt: str) -> str:
    """Regular expression that text of a layout must match."""
    digits = {"y", "M", "d", "H", "h", "m", "s"}
    out = []
    for match in re.finditer(r"'([^']*)'|(([A-Za-z])\3*)|(.)", fmt):
        quoted, letters, letter, other = match.groups()
        if letters is None:
            out.append(re.escape(quoted if quoted is not None else other))
        elif letter == "a":
            out.append("[AaPp][Mm]")
        elif letter == "M" and len(letters) == 3:
            out.append("[A-Za-z]{3}")
        elif letter in digits:
            out.append(r"\d{1,2}" if len(letters) == 1 else rf"\d{{{len(letters)}}}")
        else:
            out.append(".+")
    return f"^{''.join(out)}$"


def _try_format(col: Column, fmt: str) -> Column:
    # Cheap tests spare the parser text that cannot fit, which it is slow to refuse.
    marks = re.sub(r"'[^']*'|[A-Za-z :]", "", fmt)
    likely = col.contains(marks[0]) if marks else F.length(col) == len(fmt.replace("'", ""))
    return F.when(likely & col.rlike(_shape(fmt)), F.try_to_timestamp(col, F.lit(fmt)))


def iso_timestamp(col: Column) -> Column:
    """ISO-8601 text (with ``T``, fraction, ``Z`` or ``+hhmm``) to a UTC timestamp."""
    is_iso = (F.substring(col, 5, 1) == "-") & (F.substring(col, 8, 1) == "-")
    short_zone = (F.length(col) > 19) & F.substring(col, -5, 1).isin("+", "-")
    zoned = F.concat(F.substring(col, F.lit(1), F.length(col) - 2), F.lit(":"), F.right(col, F.lit(2)))
    return F.when(is_iso, F.when(short_zone, zoned).otherwise(col).try_cast("timestamp"))


def parse_ts(
    col: Column,
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    on_bad: str = "null",
) -> Column:
    """First layout that fits wins. ``on_bad='raise'`` fails on text that fits none."""
    tries = [iso_timestamp(col)] + [_try_format(col, f) for f in formats]
    parsed = F.coalesce(*tries)
    if on_bad == "raise":
        message = F.concat(F.lit("unparseable timestamp: "), col)
        return F.when(col.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)
    return parsed


def parse_date(col: Column, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Mixed date text to a date, earlier layouts first."""
    return F.coalesce(*[_try_format(col, f) for f in formats]).cast("date")


def fill_fraction(col: Column) -> Column:
    """ISO text without fractional seconds gets ``.000000``; other text is left alone."""
    return F.regexp_replace(col, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})$", "$1.000000")


def day_window(ts: Column, first: dt.date, last: dt.date | None = None) -> Column:
    """Half-open test for whole days, so no fraction of the last second is lost."""
    end = (last or first) + dt.timedelta(days=1)
    return (ts >= F.lit(first)) & (ts < F.lit(end))


def date_span(start: str | None, end: str | None, today: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of a span given as ``YYYYMMDD`` texts; yesterday alone if one is not given."""

    def day_of(text: str) -> dt.date:
        if len(text) != 8 or not text.isdecimal():
            raise ValueError(f"{text!r} is not eight digits")
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))

    if not (start and end):
        return (yesterday := today - dt.timedelta(days=1)), yesterday
    span = day_of(start), day_of(end)
    if span[1] < span[0]:
        raise ValueError(f"{end} is before {start}")
    return span
