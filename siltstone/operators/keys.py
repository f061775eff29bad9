"""Per-key selection, deduplication and numbering."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.dates import ts_literal
from siltstone.operators.joins import skew_join
from siltstone.operators.numbering import numbered
from siltstone.session import materialize

_RANK = "__rank"

# Rows that one task numbers in surrogate_id, about.
ROWS_PER_BUCKET = 1_000_000
# Beyond so many ranges they grow instead: the driver gets a sample, a border and a result for each one.
MAX_BUCKETS = 1_000


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # A filter on row_number() = 1 lets Spark keep one row per key inside each map
    # task before the shuffle, so a hot key never reaches a reducer whole.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _ties(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str]) -> list[Column]:
    """The given ties, then all other columns: rows that still tie are equal."""
    given = {*keys, order, *ties}
    rest = [f.name for f in df.schema if f.name not in given and _orderable(f.dataType)]
    return [F.col(f"`{t}`").asc_nulls_last() for t in (*ties, *rest)]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key. ``ties`` (ascending) decide first, then all other columns.

    The choice does not depend on how rows are partitioned, but every column of ``df`` is read: select
    the needed ones before. Columns of maps cannot be compared and do not take part.
    """
    return _ranked(df, keys, [F.col(order).desc_nulls_last(), *_ties(df, keys, order, ties)])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Oldest row per key, nulls last; ties as in :func:`latest_per_key`."""
    return _ranked(df, keys, [F.col(order).asc_nulls_last(), *_ties(df, keys, order, ties)])


def _written(per_key: DataFrame) -> DataFrame:
    """One row per key, written: an aggregate in the stage of its join would keep Spark from splitting a hot key."""
    return materialize(per_key, "per-key")


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that carry the newest value of ``order`` for their key."""
    newest = _written(df.groupBy(*keys).agg(F.max(order).alias(order)))
    return skew_join(df, newest, [*keys, order], "left_semi")


def first_seen(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    name: str = "first_seen",
    since: dt.datetime | None = None,
) -> DataFrame:
    """Attach the first ``ts`` per key; with ``since``, keep keys first seen from then on."""
    firsts = _written(df.groupBy(*keys).agg(F.min(ts).alias(name)))
    if since is None:
        return skew_join(df, firsts, keys, "left")
    return skew_join(df, firsts.where(F.col(name) >= ts_literal(since)), keys, "inner")


def dedup_newest(df: DataFrame, ts: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct business row, carrying its newest ``ts``.

    Copies collapse inside each map task; no sort and no wide shuffle of copies. ``keys``, where
    given, must name all columns but ``ts``: for fewer, ``latest_per_key`` keeps the newest row whole.
    """
    columns = [c for c in df.columns if c != ts]
    if keys and set(keys) != set(columns):
        raise ValueError(f"keys leave columns out: {sorted(set(columns) - set(keys))}")
    return df.groupBy(*columns).agg(F.max(ts).alias(ts))


def dedup(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or the distinct combinations of the given columns."""
    return df.select(*columns).distinct() if columns else df.distinct()


def surrogate_id(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Dense 1..n ids in key order, nulls last; ``keys`` must identify a row.

    The rows are dealt by key ranges of about ``rows_per_bucket``, or ``MAX_BUCKETS`` larger ones, sorted
    and written, and shifted by the sizes of the ranges ahead of them: see
    :func:`siltstone.operators.numbering.numbered`. What the driver gets does not grow with the table.
    """
    ranges = min(MAX_BUCKETS, max(1, -(-df.count() // rows_per_bucket)))
    place = f"__{name}"
    rows = numbered(df, [F.col(f"`{k}`").asc_nulls_last() for k in keys], place, ranges)
    return rows.withColumn(name, F.col(place) + 1).drop(place)
