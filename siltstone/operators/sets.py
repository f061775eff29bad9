"""Differences, unions, manifests and snapshot merge."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.joins import anti


def id_diff(
    today: DataFrame,
    yesterday: DataFrame,
    key: str,
    labelled: bool = True,
    labels: tuple[str, str] = ("Only in Today", "Only in Yesterday"),
) -> DataFrame:
    """Ids present on one side only. One shuffle; repeats collapse in the map tasks."""
    sides = today.select(F.col(key), F.lit(1).alias("t"), F.lit(0).alias("y")).unionByName(
        yesterday.select(F.col(key), F.lit(0).alias("t"), F.lit(1).alias("y"))
    )
    seen = sides.groupBy(key).agg(F.max("t").alias("t"), F.max("y").alias("y"))
    changed = seen.where(F.col("t") != F.col("y"))
    if not labelled:
        return changed.select(key)
    label = F.when(F.col("t") == 1, labels[0]).otherwise(labels[1])
    return changed.select(key, label.alias("difference_type"))


def new_items(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the manifest."""
    return anti(df, seen, [key])


def mark_seen(seen: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The manifest after a run: distinct keys of both sides."""
    return seen.select(key).unionByName(done.select(key)).distinct()


def union_evolve(*frames: DataFrame) -> DataFrame:
    """Bag union by name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_evolve(*frames).distinct()


def snapshot_merge(
    prev: DataFrame,
    now: DataFrame,
    key: str,
    carried: Callable[[Callable[[str], Column], Callable[[str], Column]], Sequence[Column]],
    fresh: Callable[[Callable[[str], Column]], Sequence[Column]],
    admit: Callable[[Callable[[str], Column]], Column],
) -> DataFrame:
    """Yesterday's snapshot updated with today's state, plus today's new keys.

    ``carried(old, new)`` gives the columns of keys already in the snapshot (``new`` is
    null when today has no row), ``fresh(new)`` those of unseen keys, which are appended
    when ``admit(new)`` holds. Both sides meet in one full outer join on the key, of
    which each has one row, and one projection picks the form of the row.
    """
    old_side = prev.select(*[F.col(c).alias(f"old_{c}") for c in prev.columns], F.lit(1).alias("__o"))
    new_side = now.select(*[F.col(c).alias(f"new_{c}") for c in now.columns], F.lit(1).alias("__n"))
    both = old_side.join(new_side, F.col(f"old_{key}") == F.col(f"new_{key}"), "full_outer")

    def old(name: str) -> Column:
        return F.col(f"old_{name}")

    def new(name: str) -> Column:
        return F.col(f"new_{name}")

    is_old = F.col("__o").isNotNull()
    kept = both.where(is_old | F.coalesce(admit(new), F.lit(False)))
    carried_cols, fresh_cols = list(carried(old, new)), list(fresh(new))
    row = F.when(is_old, F.struct(*carried_cols)).otherwise(F.struct(*fresh_cols))
    return kept.select(row.alias("r")).select("r.*")
