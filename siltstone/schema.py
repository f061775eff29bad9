"""Declared tables: ``{column: type text}`` and column comments to and from Spark schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of declared types that differ from Spark DDL.
TYPE_ALIASES = {"datetime": "timestamp", "real": "float", "varchar": "string", "integer": "int"}


def type_name(declared: str) -> str:
    lowered = declared.strip().lower()
    return TYPE_ALIASES.get(lowered, lowered)


def to_struct(
    declared: Mapping[str, str], comments: Mapping[str, str] | None = None
) -> T.StructType:
    fields = []
    for name, kind in declared.items():
        dtype = T.StructType.fromDDL(f"`{name}` {type_name(kind)}")[0].dataType
        comment = (comments or {}).get(name)
        fields.append(T.StructField(name, dtype, True, {"comment": comment} if comment else {}))
    return T.StructType(fields)


def to_declared(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach comments as column metadata; ``saveAsTable`` stores them in the catalog."""
    return df.select(
        *[
            F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


# Catalog type written for each column type of a described table.
CATALOG_TYPES = {
    "string": "string",
    "bigint": "float",
    "double": "float",
    "boolean": "boolean",
}


def describe_schema(
    df: DataFrame, comments: Mapping[str, str] | None = None
) -> tuple[dict[str, str], dict[str, str]]:
    """Catalog entry of a table: (types, comments), with a default comment per column."""
    types, texts = {}, {}
    for field in df.schema:
        spark_type = field.dataType.simpleString()
        types[field.name] = (
            "timestamp"
            if field.name == "timestamp_extracted"
            else CATALOG_TYPES.get(spark_type, spark_type)
        )
        default = f"This is the {field.name.replace('_', ' ')} column."
        texts[field.name] = (comments or {}).get(field.name, default)
    return types, texts
