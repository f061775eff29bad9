"""Joins. Adaptive execution splits skewed partitions of the shuffle; no side is read twice for it.

For keys that a caller knows to be hot, a salt spreads them ahead of the shuffle. No join counts
anything or runs a job while it is built.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of a given hot key are spread over.
SALTS = 16
_SALT = "__salt"


def _is_hot(df: DataFrame, keys: Sequence[str], hot: Sequence[tuple]) -> Column:
    """True for the given keys; false for keys with a null, which never match anything."""
    types = [df.schema[k].dataType for k in keys]
    rows = [F.struct(*[F.lit(v).cast(t) for v, t in zip(vs, types)]) for vs in hot]
    return F.coalesce(F.struct(*[F.col(f"`{k}`") for k in keys]).isin(rows), F.lit(False))


def skew_join(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot: Sequence[tuple] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table to rows keyed by ``on``.

    Without ``hot`` this is an ordinary join, whose skewed partitions adaptive execution splits. The
    rows of the keys in ``hot`` (tuples, one value per column) get a salt from their own values, and
    the ``dim`` rows of these keys are repeated once for each salt. ``how`` must keep the rows of
    ``df`` or only matches: inner, left, left_semi or left_anti.
    """
    on = list(on)
    if not hot:
        return df.join(dim, on, how)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"hot keys cannot be salted in a {how} join")
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    salted = df.withColumn(_SALT, F.when(_is_hot(df, on, hot), spread).otherwise(0))
    last = F.when(_is_hot(dim, on, hot), F.lit(salts - 1)).otherwise(0)
    repeated = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def one_to_many(
    dim: DataFrame, df: DataFrame, on: Sequence[str], hot: Sequence[tuple] = (), salts: int = SALTS
) -> DataFrame:
    """``dim`` LEFT JOIN ``df``, where ``df`` may have hot keys.

    A given hot key's ``dim`` rows are repeated once for each salt and meet the matching share of the
    key's rows; the repetition with salt 0 stands for those without a match.
    """
    on = list(on)
    if not hot:
        return dim.join(df, on, "left")
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    many = df.withColumn(_SALT, F.when(_is_hot(df, on, hot), spread).otherwise(0)).withColumn("__match", F.lit(1))
    # One row per hot key says whether it has any match at all.
    known = df.where(_is_hot(df, on, hot)).select(*on).distinct().withColumn("__some", F.lit(1))
    last = F.when(_is_hot(dim, on, hot), F.lit(salts - 1)).otherwise(0)
    repeated = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
    joined = repeated.join(many, [*on, _SALT], "left").join(known, on, "left")
    alone = F.col("__match").isNull() & (F.col("__some").isNotNull() | (F.col(_SALT) > 0))
    return joined.where(~alone).drop(_SALT, "__match", "__some")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: Mapping[str, str] | str,
    how: str = "left",
    hot: Sequence[tuple] = (),
) -> DataFrame:
    """Enrich ``df`` with the columns of ``dim``; ``key`` may map df column to dim column."""
    pairs = {key: key} if isinstance(key, str) else dict(key)
    aligned = dim.withColumnsRenamed({d: k for k, d in pairs.items() if d != k})
    return skew_join(df, aligned, list(pairs), how, hot)


def semi(df: DataFrame, other: DataFrame, on: Sequence[str], hot: Sequence[tuple] = ()) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return skew_join(df, other.select(*on), on, "left_semi", hot)


def anti(df: DataFrame, other: DataFrame, on: Sequence[str], hot: Sequence[tuple] = ()) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return skew_join(df, other.select(*on), on, "left_anti", hot)


def matched_flag(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    name: str,
    yes: str = "Y",
    no: str = " ",
    hot: Sequence[tuple] = (),
) -> DataFrame:
    """``yes`` where the key exists in ``dim``, else ``no``; rows never fan out."""
    present = dim.select(*on).dropna().distinct().withColumn(name, F.lit(yes))
    joined = skew_join(df, present, on, "left", hot)
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(no)).alias(name))


def work_list(keys: DataFrame, first: dt.date, last: dt.date, name: str = "date") -> DataFrame:
    """Every key with every day of the span; the days are generated per row."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return keys.withColumn(name, F.explode(days))


def pairs_to_columns(
    df: DataFrame, by: Sequence[str], pair: str, value: str, pairs: Sequence[str]
) -> DataFrame:
    """One column per pair (declared list), one row per ``by``; smallest value on repeats."""
    cells = [F.min(F.when(F.col(pair) == p, F.col(value))).alias(p) for p in pairs]
    return df.groupBy(*by).agg(*cells)
