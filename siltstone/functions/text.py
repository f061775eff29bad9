"""String expressions. Everything returns a Column built from built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Unicode blocks that hold Arabic script.
ARABIC_RANGES = (
    ("\u0600", "\u06ff"),
    ("\u0750", "\u077f"),
    ("\u08a0", "\u08ff"),
    ("\ufb50", "\ufdff"),
    ("\ufe70", "\ufeff"),
)


def clean_text(col: Column) -> Column:
    """Line breaks and tabs become spaces, then one pass of double to single space."""
    spaced = F.translate(col, "\n\r\t", "   ")
    return F.replace(spaced, F.lit("  "), F.lit(" "))


def clean_nested(col: Column, dtype: T.DataType) -> Column:
    """``clean_text`` applied to every string inside arrays, structs and map values."""
    if isinstance(dtype, T.StringType):
        return clean_text(col)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: clean_nested(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: clean_nested(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        parts = [clean_nested(col[f.name], f.dataType).alias(f.name) for f in dtype]
        return F.when(col.isNotNull(), F.struct(*parts))
    return col


def strip_end(col: Column, chars: str) -> Column:
    """Drop any run of the given characters from the end."""
    return F.rtrim(col, F.lit(chars))


def join_strict(sep: str, *cols: Column) -> Column:
    """Concatenate with a separator; null as soon as one part is null."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def range_string(currency: Column, low: Column, high: Column) -> Column:
    """``CUR_from_to``, the storage form of an amount range."""
    return join_strict("_", currency, low, high)


def token(col: Column, position: int, sep: str = "_", default: str | None = None) -> Column:
    """The n-th (1-based) token; ``default`` when the text has fewer tokens."""
    found = F.try_element_at(F.split(col, _literal_regex(sep)), F.lit(position))
    return found if default is None else F.coalesce(found, F.lit(default))


def has_script(col: Column, ranges: Sequence[tuple[str, str]] = ARABIC_RANGES) -> Column:
    """True when at least one character lies in the given code point ranges."""
    body = "".join(f"{low}-{high}" for low, high in ranges)
    return col.rlike(f"[{body}]")


def contains_any(col: Column, *needles: str) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | col.contains(needle)
    return found


def zero_pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def replace_literal(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def decode_key(col: Column, plus_is_space: bool = True) -> Column:
    """URL-decode an object key; ``+`` stays as it is unless it stands for a space."""
    source = col if plus_is_space else F.replace(col, F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(source)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _literal_regex(text: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|" else ch for ch in text)
