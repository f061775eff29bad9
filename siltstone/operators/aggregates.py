"""Conditional sums. Each is one grouped pass with map-side partial sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import token

#: Amounts keep six decimals: more than any currency has.
AMOUNT = "decimal(38,6)"


def filtered_sums(
    df: DataFrame,
    keys: Sequence[str],
    amount: Column,
    cases: Mapping[str, Column],
    where: Column | None = None,
    type_name: str = AMOUNT,
    unreadable: str | None = None,
) -> DataFrame:
    """One sum per case and key; null where a key has no row of the case.

    Amounts are summed exactly and returned as double. ``unreadable`` names a column that counts the
    amounts of a key that are set but are no number.
    """
    source = df if where is None else df.where(where)
    exact = amount.try_cast(type_name)
    sums = [F.sum(F.when(cond, exact)).cast("double").alias(name) for name, cond in cases.items()]
    if unreadable is not None:
        sums.append(F.count_if(amount.isNotNull() & exact.isNull()).alias(unreadable))
    return source.groupBy(*keys).agg(*sums)


def lower_bound(range_text: Column) -> Column:
    """Lower amount of a ``CUR_from_to`` range; 0 when the text or its amount is absent, null if unreadable."""
    number = token(F.coalesce(range_text, F.lit("0_0_0")), 2, default="0")
    return number.try_cast(AMOUNT)


def class_sums(
    df: DataFrame,
    key: str,
    items: Sequence[tuple[str, str]] | Column,
    classes: Mapping[str, Sequence[str]],
    rest: str,
    unreadable: str | None = None,
) -> DataFrame:
    """Sum the lower bounds of repeated (type, range) items by class and key.

    ``items`` names column pairs, or is an array column of structs ``type, range`` of any length.
    Types that no class lists, null included, count towards ``rest``. Every item adds its own amount;
    ``unreadable`` names a column that counts amounts that are no number. Equal rows count once.
    """
    listed = [t for types in classes.values() for t in types]
    if not isinstance(items, Column):
        items = F.array(*[F.struct(F.col(t).alias("type"), F.col(r).alias("range")) for t, r in items])
    rows = df.select(key, items.alias("items")).distinct()
    parsed = rows.select(
        key, F.transform("items", lambda x: F.struct(x["type"].alias("type"), lower_bound(x["range"]).alias("low"))).alias("items")
    )

    def is_class(kind: Column, name: str) -> Column:
        if name == rest:
            return ~F.coalesce(kind.isin(*listed), F.lit(False))
        return F.coalesce(kind.isin(*classes[name]), F.lit(False))

    def class_sum(name: str) -> Column:
        return F.aggregate(
            F.col("items"),
            F.lit(0).cast(AMOUNT),
            lambda acc, x: (
                acc + F.when(is_class(x["type"], name), F.coalesce(x["low"], F.lit(0))).otherwise(0)
            ).cast(AMOUNT),
        )

    cells = {n: F.coalesce(class_sum(n), F.lit(0).cast(AMOUNT)) for n in [*classes, rest]}
    if unreadable is not None:
        cells[unreadable] = F.coalesce(F.size(F.filter("items", lambda x: x["low"].isNull())), F.lit(0)).cast("long")
    per_row = parsed.select(key, *[c.alias(n) for n, c in cells.items()])
    return per_row.groupBy(key).agg(*[F.sum(n).alias(n) for n in cells])
