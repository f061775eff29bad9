"""Column selection, renaming and projection to a declared schema."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import parse_date, parse_ts
from siltstone.schema import type_name

_NUMERIC = ("int", "bigint", "float", "double", "decimal", "smallint", "tinyint")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def keep_listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed columns that exist, in the order of the input."""
    wanted = set(names)
    return df.select(*[_col(c) for c in df.columns if c in wanted])


def keep_declared(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed columns that exist, in the order of the list."""
    present = set(df.columns)
    return df.select(*[_col(c) for c in names if c in present])


def extra_columns(df: DataFrame, declared: Mapping[str, str]) -> list[str]:
    """Columns of the input that the schema does not know."""
    return [c for c in df.columns if c not in declared]


def project_existing(
    df: DataFrame, wanted: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Wanted columns that the table has; the predicate may use any column."""
    filtered = df if where is None else df.where(where)
    return keep_declared(filtered, wanted)


def named_projection(
    df: DataFrame, catalog: Mapping[str, tuple[Sequence[str], Column | None]], name: str
) -> DataFrame:
    """One entry of a catalog of (columns, predicate)."""
    columns, where = catalog[name]
    return project_existing(df, columns, where)


def conform(
    df: DataFrame,
    schema: Mapping[str, str],
    fill_missing: bool = True,
    on_bad: str = "null",
) -> DataFrame:
    """Project by name to the declared columns, order and types.

    Values that do not fit become null; ``on_bad='zero'`` turns bad numbers into 0 and
    ``on_bad='raise'`` fails the job. Date text may have any layout that inference knows.
    Missing columns are null-filled, or left out with ``fill_missing=False``. Nulls stay
    null, also in text columns.
    """
    present = dict(df.dtypes)
    out = []
    for name, declared in schema.items():
        kind = type_name(declared)
        if name not in present:
            if fill_missing:
                out.append(F.lit(None).cast(kind).alias(name))
            continue
        value = _col(name)
        if kind == present[name]:
            cast = value
        elif kind in ("timestamp", "date") and present[name] == "string":
            cast = F.coalesce(parse_ts(value).cast(kind), parse_date(value).cast(kind))
        else:
            cast = value.try_cast(kind)
            if on_bad == "zero" and kind.startswith(_NUMERIC):
                cast = F.coalesce(cast, F.lit(0).cast(kind))
        if on_bad == "raise":
            lost = value.isNotNull() & cast.isNull()
            message = F.lit(f"column {name} has a value that is not {kind}")
            cast = F.when(lost, F.raise_error(message)).otherwise(cast)
        out.append(cast.alias(name))
    return df.select(*out)


def fill_blank(df: DataFrame, expected: Sequence[str], value: str = "") -> DataFrame:
    """Add expected columns that are missing, filled with a constant."""
    missing = [c for c in expected if c not in df.columns]
    return df.withColumns({c: F.lit(value) for c in missing}) if missing else df


def drop_prefixed(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position. Prefer ``conform``, which matches by name."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns cannot take {len(names)} names")
    return df.toDF(*names)


# Fixed value: where a camelCase name gets an underscore.
WORD_START = "(?!^)([A-Z]+)"


def snake_case(df: DataFrame) -> DataFrame:
    """camelCase names to snake_case; a run of capitals counts as one word start."""
    return _renamed(df, [re.sub(WORD_START, r"_\1", c).lower() for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.lower() for c in df.columns])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)
