"""Snapshots stored in buckets of their key, so that a merge moves only the new day's rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.sets import snapshot_merge

#: Buckets of a snapshot: each is one task of a merge.
BUCKETS = 64


def write_snapshot(df: DataFrame, table: str, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a snapshot as a bucketed catalog table; each bucket is one sorted file.

    Rows that lie by bucket already, as those of a merge do, are dealt again: their partitioning
    is not known after an outer join. That is a shuffle of the result, not of the old snapshot.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def merge_into_next(
    previous: str,
    now: DataFrame,
    key: str,
    carried: Callable[[Callable[[str], Column], Callable[[str], Column]], Sequence[Column]],
    fresh: Callable[[Callable[[str], Column]], Sequence[Column]],
    admit: Callable[[Callable[[str], Column]], Column],
    buckets: int = BUCKETS,
) -> DataFrame:
    """:func:`siltstone.operators.sets.snapshot_merge` with a stored snapshot, which is read in place.

    Both sides have one row for each key. The new side is dealt into the snapshot's buckets, and the
    join reads the snapshot bucket by bucket.
    """
    spark = now.sparkSession
    stored = spark.table(previous)
    dealt = now.repartition(buckets, F.col(key))
    return snapshot_merge(stored, dealt, key, carried, fresh, admit)
