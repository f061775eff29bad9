"""Column profiles, schema inference, run summaries and size estimates.

A profile is one aggregate pass over all columns; inference reads the one-row result, and a second
pass over the columns that may hold times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import parse_date, parse_ts

# Text that stands for a missing value.
NULL_TOKENS = ("None", "")

# Whole numbers as digits, whole numbers as written in code (no leading zero), decimals.
_DIGITS = r"^[+-]?[0-9]+$"
_INT = r"^[+-]?(0+|[1-9][0-9]*)$"
_FLOAT = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$"

#: Measures of plain text tests, and those that try time layouts on every value.
QUICK = ("n", "n_set", "n_digits", "n_int", "n_long", "n_float", "n_bool", "n_marked", "min_int", "max_int")
TIMES = ("n_time", "n_midnight", "n_compact")
MEASURES = (*QUICK, *TIMES)


def _maybe_time(text: Column) -> Column:
    """Every known layout has one of these marks or one of these lengths."""
    marks = text.contains("-") | text.contains("/") | text.contains(",")
    return marks | F.length(text).isin(8, 12)


def _facts(col: Column) -> dict[str, Column]:
    """What one value is; each fact is worked out once and then counted."""
    text = F.when(~col.cast("string").isin(*NULL_TOKENS), col.cast("string"))
    return {
        "text": text,
        "whole": text.rlike(_INT),
        "stamp": F.when(_maybe_time(text), F.coalesce(parse_ts(text), parse_date(text).cast("timestamp"))),
    }


def _measures(text: Column, whole: Column, stamp: Column) -> dict[str, Column]:
    number = F.when(whole, text.try_cast("bigint"))
    compact = F.when((F.length(text) == 8) & text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    return {
        "n": F.count("*"),
        "n_set": F.count(text),
        "n_digits": F.count_if(whole | text.rlike(_DIGITS)),
        "n_int": F.count_if(whole),
        "n_long": F.count(number),
        "n_float": F.count_if(whole | text.rlike(_FLOAT)),
        "n_bool": F.count_if(F.lower(text).isin("true", "false")),
        "n_marked": F.count_if(_maybe_time(text)),
        "n_time": F.count(stamp),
        "n_midnight": F.count_if(stamp == F.date_trunc("day", stamp)),
        "n_compact": F.count(compact),
        "min_int": F.min(number),
        "max_int": F.max(number),
    }


def profile(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per column: how many values are set, and of what kind they could be.

    Only the named measures are taken; those of ``TIMES`` cost most.
    """
    names = df.columns
    facts = df.select(
        *[
            expr.alias(f"{i}_{fact}")
            for i, name in enumerate(names)
            for fact, expr in _facts(F.col(f"`{name}`")).items()
        ]
    )  # unused facts are pruned
    wide = facts.agg(
        *[
            expr.cast("long").alias(f"{i}_{measure}")
            for i in range(len(names))
            for measure, expr in _measures(
                *[F.col(f"`{i}_{fact}`") for fact in ("text", "whole", "stamp")]
            ).items()
            if measure in measures
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                *[F.col(f"`{i}_{m}`").alias(m) for m in MEASURES if m in measures],
            )
            for i, name in enumerate(names)
        ]
    )
    return wide.select(F.inline(rows))


def _whole_type(p) -> str:
    small = p["min_int"] >= -(2**31) and p["max_int"] <= 2**31 - 1
    return "int" if small else "bigint"


def _by_content(p, name: str) -> str:
    if p["n_set"] == 0:
        return "string"
    # Leading zeros and numbers beyond 64 bits are not literals.
    if "date" not in name.lower() and p["n_digits"] == p["n_long"]:
        if p["n_int"] == p["n_set"]:
            return _whole_type(p)
        if p["n_float"] == p["n_set"]:
            return "double"
        if p["n_bool"] == p["n_set"]:
            return "boolean"
    if p["n_time"] == p["n_set"] and name != "date":
        return "date" if p["n_midnight"] == p["n_set"] else "timestamp"
    return "string"


def _by_dates(p, name: str) -> str:
    # An empty text column counts as a date column.
    return "date" if p["n_midnight"] == p["n_set"] else "string"


def _by_numbers(p, name: str) -> str:
    if p["n_set"] == 0:
        return "string"
    if p["n_float"] == p["n_set"]:
        return _whole_type(p) if p["n_long"] == p["n"] else "double"
    return "timestamp" if p["n_compact"] == p["n_set"] else "string"


RULES = {"content": _by_content, "dates": _by_dates, "numbers": _by_numbers}

# Declared type of columns that are not text.
NATIVE_TYPES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint",
    "float": "double", "double": "double", "boolean": "boolean",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "timestamp",
}


def infer_schema(df: DataFrame, rules: str = "content") -> dict[str, str]:
    """Declared types from whole-column truth.

    ``content`` judges every column by its text; ``dates`` tests text columns for dates
    and maps the others by type; ``numbers`` tries numbers, then compact dates.
    """
    judge = RULES[rules]
    types = dict(df.dtypes)
    judged = [c for c in df.columns if rules != "dates" or types[c] == "string"]
    found: dict[str, str] = {}
    if judged:
        # One value without any mark of a time rules times out, one that is no number numbers: only
        # columns with neither counterexample are read again, by the parser, and then whole.
        quick = profile(df.select(*[F.col(f"`{c}`") for c in judged]), QUICK).collect()
        told = {r["column_name"]: r.asDict() | dict.fromkeys(TIMES, 0 if r["n_set"] == 0 else -1) for r in quick}
        open_ones = [c for c, p in told.items() if p["n_set"] and p["n_marked"] == p["n_set"]]
        if open_ones:
            for r in profile(df.select(*[F.col(f"`{c}`") for c in open_ones]), TIMES).collect():
                told[r["column_name"]] |= {m: r[m] for m in TIMES}
        found = {c: judge(p, c) for c, p in told.items()}
    return {c: found.get(c) or NATIVE_TYPES.get(types[c], "string") for c in df.columns}


def run_summary(df: DataFrame, unit: Sequence[str], ok: Column, count: Column | None = None) -> DataFrame:
    """Processed and failed counts per unit with its status."""
    records = F.lit(1) if count is None else count
    done = F.count_if(ok)
    failed = F.count_if(~F.coalesce(ok, F.lit(False)))
    return df.groupBy(*unit).agg(
        done.alias("processed"),
        failed.alias("failed"),
        F.coalesce(F.sum(F.when(ok, records)), F.lit(0)).cast("long").alias("records"),
        F.when(failed == 0, "completed").otherwise("partial").alias("status"),
    )


def overall_status(summary: DataFrame) -> DataFrame:
    """One row over a run summary; ``partial`` as soon as one unit failed."""
    return summary.agg(
        F.sum("processed").alias("processed"),
        F.sum("failed").alias("failed"),
        F.sum("records").alias("records"),
        F.when(F.max("failed") > 0, "partial").otherwise("completed").alias("status"),
    )


def size_estimate(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text length of the given columns summed over the table (one pass, no shuffle of rows)."""
    parts = [F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in columns or df.columns]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return df.agg(F.sum(total.cast("long")).alias("n_bytes"), F.count("*").alias("n_rows"))
