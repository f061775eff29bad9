"""Row numbers in the order of a whole table, without one global task and without borders in the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import materialize

#: Bits of a row's place inside its partition, as ``monotonically_increasing_id`` numbers rows.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with its row numbers 0..n-1 in the given order, as column ``name``.

    The rows are dealt by ranges of the order, sorted inside each range and written together with their
    place there. What stands before a range is the sum of the sizes of the ranges ahead of it: a table
    with one row for each partition, which is all that is broadcast. Rows that are equal in ``order``
    meet in one range, so a hot value needs further columns in the order. The order of equal rows is
    arbitrary, but the written table keeps it for all that reads the result.
    """
    place, part = f"__place_{name}", f"__part_{name}"
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    written = materialize(
        dealt.sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "numbered"
    ).withColumn(part, F.shiftrightunsigned(place, _PLACE_BITS))
    # At most one row for each partition: small whatever the table's size.
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = written.groupBy(part).agg(F.count("*").alias("__size"))
    offsets = sizes.select(part, F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__ahead"))
    inside = F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    joined = written.join(F.broadcast(offsets), part)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__ahead") + inside).alias(name))
