"""Tables whose schema changes: a log of versions over a lattice of types, and reads that cast old files.

Every append keeps its own types on disk. The log holds the join of all schemas so far: a column has the
least type that holds every value of its versions unchanged, text where there is no other. Columns
that became text because their types have nothing else in common are marked.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources import versions

# Wider types that hold every value of a type unchanged, text aside.
_WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "bigint": (),
    "float": ("double",),
    "double": (),
    "date": (),
    "boolean": (),
    "void": ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean", "timestamp", "timestamp_ntz", "binary"),
}


def join_types(one: T.DataType, other: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text if only that does."""
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return join_schemas(one, other)
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(join_types(one.elementType, other.elementType))
    if isinstance(one, T.MapType) and isinstance(other, T.MapType) and one.keyType == other.keyType:
        return T.MapType(one.keyType, join_types(one.valueType, other.valueType))
    if isinstance(one, T.NullType) or isinstance(other, T.NullType):
        return other if isinstance(one, T.NullType) else one
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        whole = max(one.precision - one.scale, other.precision - other.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    names = [(t.simpleString(), t) for t in (one, other)]
    for (name, kind), (wide, _) in (names, names[::-1]):
        if name in _WIDER.get(wide, ()):
            return kind
    return T.StringType()


def join_schemas(one: T.StructType, other: T.StructType) -> T.StructType:
    """All columns of both by name, in order of appearance, each with the join of its types."""
    types = {f.name: f.dataType for f in one}
    for f in other:
        types[f.name] = join_types(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` in a wider type; documents become text as JSON, fields that it lacks null."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have}
        fields = [(_cast(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def schemas(spark: SparkSession, root: str) -> dict[int, tuple[T.StructType, T.StructType]]:
    """By version: the schema that was written, and the table's from then on. One row for each version."""
    found = versions.entries(spark, root)
    rows = found.select("version", "written", "schema").collect() if found is not None else []
    return {r["version"]: tuple(T.StructType.fromJson(json.loads(r[c])) for c in ("written", "schema")) for r in sorted(rows)}


def append(df: DataFrame, root: str, batch: str) -> int:
    """Write rows as the next version, in their own types; a batch that was written before does nothing.

    Names that differ in case only are one column to Spark: they are refused.
    """
    spark = df.sparkSession
    done = versions.version_of(spark, root, batch)
    if done is not None:
        return done
    known = schemas(spark, root)
    version = max(known, default=0) + 1
    written = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    joined = join_schemas(known[version - 1][1], written) if known else written
    lowered = [f.name.lower() for f in joined]
    if len(set(lowered)) < len(lowered):
        raise ValueError(f"columns differ in case only: {joined.names}")
    df.write.mode("overwrite").parquet(f"{root}/data/version={version}")
    row = spark.createDataFrame([(json.dumps(written.jsonValue()), json.dumps(joined.jsonValue()))], "written string, schema string")
    versions.publish(row, root, version, batch)
    return version


def conflicts(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Top-level columns that are text although no version, or not every one, wrote text: their types in order."""
    known = schemas(spark, root)
    out = {}
    for f in known[max(known)][1]:
        had = list(dict.fromkeys(w[f.name].dataType.simpleString() for w, _ in known.values() if f.name in w.names))
        if isinstance(f.dataType, T.StringType) and had != ["string"]:
            out[f.name] = had
    return out


def read_evolved(spark: SparkSession, root: str) -> DataFrame:
    """All rows in the newest schema. Each version is read in its own types, so filters and columns reach its files."""
    known = schemas(spark, root)
    if not known:
        raise ValueError(f"no table below {root}")
    want = known[max(known)][1]

    def part(version: int) -> DataFrame:
        written = known[version][0]
        own = {f.name: f.dataType for f in written}
        rows = spark.read.schema(written).parquet(f"{root}/data/version={version}")
        return rows.select(
            *[(_cast(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        )

    return reduce(DataFrame.unionByName, [part(v) for v in known])
