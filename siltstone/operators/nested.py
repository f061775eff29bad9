"""Nested documents: flattening, parsing, key extraction, unwrapping."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.conform import drop_prefixed


def _array_sizes(dtype: T.DataType, path: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """For every array below ``dtype``: its path and its largest size within one row."""
    if isinstance(dtype, T.StructType):
        return [
            (inner_path, lambda c, n=f.name, size=size: size(c[n]))
            for f in dtype
            for inner_path, size in _array_sizes(f.dataType, f"{path}.{f.name}")
        ]
    if isinstance(dtype, T.ArrayType):
        inner = [
            (inner_path, lambda c, size=size: F.array_max(F.transform(c, size)))
            for inner_path, size in _array_sizes(dtype.elementType, f"{path}[]")
        ]
        return [(path, lambda c: F.size(c)), *inner]
    return []


def array_widths(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Largest size of every array in the table, in one aggregate pass."""
    wanted = set(columns if columns is not None else df.columns)
    found = [
        (path, F.max(size(F.col(f"`{f.name}`"))))
        for f in df.schema
        if f.name in wanted
        for path, size in _array_sizes(f.dataType, f.name)
    ]
    if not found:
        return {}
    row = df.agg(*[expr.alias(f"w{i}") for i, (_, expr) in enumerate(found)]).first()
    return {path: max(0, row[i] or 0) for i, (path, _) in enumerate(found)}


def flatten(
    df: DataFrame,
    sep: str = "_",
    ignore: Sequence[str] = (),
    replace_sep: str | None = None,
    max_items: int | Mapping[str, int] | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Structs and arrays to flat columns ``a_b_0_c``.

    ``ignore`` names top-level columns to leave out, ``only`` those to flatten: others stay as they are. Array widths are declared through
    ``max_items`` (one number, or one per array path) or measured, however wide; data wider than a
    declared width fails the job instead of losing items. ``explode_items`` gives the long form.
    """
    kept = [f for f in df.schema if f.name not in set(ignore)]
    opened = [f for f in kept if only is None or f.name in only]
    declared = max_items is not None
    if isinstance(max_items, Mapping):
        widths = dict(max_items)
    elif declared:
        widths = {p: max_items for f in opened for p, _ in _array_sizes(f.dataType, f.name)}
    else:
        widths = array_widths(df, [f.name for f in opened])
    out: list[Column] = []
    names: set[str] = set()

    def name_of(prefix: str, key: str) -> str:
        part = key if replace_sep is None else key.replace(sep, replace_sep)
        return f"{prefix}{sep}{part}" if prefix else part

    def emit(col: Column, name: str) -> None:
        if name in names:
            raise ValueError(f"flattened name {name!r} occurs twice")
        names.add(name)
        out.append(col.alias(name))

    def walk(col: Column, dtype: T.DataType, name: str, path: str) -> None:
        if isinstance(dtype, T.StructType) and len(dtype):
            for f in dtype:
                walk(col[f.name], f.dataType, name_of(name, f.name), f"{path}.{f.name}")
        elif isinstance(dtype, T.ArrayType) and widths.get(path, 0) > 0:
            width = widths[path]
            items = col
            if declared:
                message = F.lit(f"array {path} has more than {width} items")
                items = F.when(F.size(col) > width, F.raise_error(message)).otherwise(col)
            for i in range(width):
                walk(F.get(items, i), dtype.elementType, name_of(name, str(i)), f"{path}[]")
        elif isinstance(dtype, (T.ArrayType, T.StructType)):
            emit(F.to_json(col), name)
        else:
            emit(col, name)

    for f in kept:
        if f in opened:
            walk(F.col(f"`{f.name}`"), f.dataType, name_of("", f.name), f.name)
        else:
            emit(F.col(f"`{f.name}`"), f.name)
    return df.select(*out)


def explode_items(df: DataFrame, column: str, position: str, item: str) -> DataFrame:
    """Long form of an array column: one row per item, rows without items are kept."""
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*others, F.posexplode_outer(F.col(f"`{column}`")).alias(position, item))


def items_to_columns(
    df: DataFrame, keys: Sequence[str], position: str, items: Sequence[str], width: int
) -> DataFrame:
    """Back from one row per item to ``<item>_0 … <item>_<width-1>``, one row per key.

    Conditional minima combine in the map tasks; no group is collected. Positions at or
    beyond ``width`` fail the job instead of being lost.
    """
    message = F.lit(f"{position} has values beyond {width - 1}")
    place = F.when(F.col(position) >= width, F.raise_error(message)).otherwise(F.col(position))
    cells = [
        F.min(F.when(F.col("__place") == i, F.col(item))).alias(f"{item}_{i}")
        for i in range(width)
        for item in items
    ]
    return df.withColumn("__place", place).groupBy(*keys).agg(*cells)


def flatten_columns(df: DataFrame, schemas: Mapping[str, str | None], sep: str = "_") -> DataFrame:
    """Replace named columns by ``<col>_<sub>`` columns, row by row.

    A column is either a struct already (schema ``None``) or JSON / literal text of the
    given DDL schema. Null documents give null columns; absent columns are skipped.
    """
    parsed = df
    for name, ddl in schemas.items():
        if ddl is not None and name in df.columns:
            parsed = parsed.withColumn(name, parse_document(F.col(f"`{name}`"), ddl))
    plain = [c for c in df.columns if c not in schemas]
    docs = [c for c in df.columns if c in schemas]
    if not docs:
        return df
    flat = flatten(parsed.select(*[F.col(f"`{c}`") for c in docs]), sep).columns
    return flatten(parsed.select(*[F.col(f"`{c}`") for c in plain + docs]), sep).select(
        *[F.col(f"`{c}`") for c in plain], *[F.col(f"`{c}`") for c in flat]
    )


# A bare word outside quotes: everything before it is skipped string by string.
_OUTSIDE = (
    r"\G((?:[^'\"{first}]++|'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    r"|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|{first}(?!{rest}\b))*+){first}{rest}\b"
)
# Literal words of the delivered text and their JSON spelling.
LITERAL_WORDS = (("None", "null"), ("True", "true"), ("False", "false"))


def _rewritten(word: str, pattern: str, by: str) -> Callable[[Column], Column]:
    return lambda x: F.when(x.contains(word), F.regexp_replace(x, pattern, by)).otherwise(x)


def literal_to_json(col: Column) -> Column:
    """Rewrite None/True/False outside quoted text; single quotes are left to the parser."""
    out = F.array(col)  # an array of one gives each step's text a name, so that it is worked out once
    for word, json_word in LITERAL_WORDS:
        pattern = _OUTSIDE.replace("{first}", word[0]).replace("{rest}", word[1:])
        out = F.transform(out, _rewritten(word, pattern, "$1" + json_word))
    # Most texts have none of the words and take no step at all.
    some = reduce(lambda a, b: a | b, [col.contains(word) for word, _ in LITERAL_WORDS])
    return F.when(some, F.get(out, F.lit(0))).otherwise(col)


def parse_document(col: Column, ddl: str) -> Column:
    """JSON text, or literal text with single quotes and None/True/False; else null."""
    opening = F.substring(F.ltrim(col), 1, 1).isin("{", "[")
    return F.when(opening, F.from_json(literal_to_json(col), ddl))


def parse_map(col: Column) -> Column:
    return parse_document(col, "map<string,string>")


def props(
    df: DataFrame, column: str, keys: Sequence[str], default: str | None = ""
) -> DataFrame:
    """Named keys of a JSON property bag as text columns; missing or null gives ``default``.

    The bag is parsed once for all keys.
    """
    ddl = ", ".join(f"`{k}` string" for k in keys)
    # The array keeps the optimizer from parsing once for each key, with one field each.
    bag = F.transform(F.array(F.from_json(F.col(column), ddl)), lambda b: b)
    parsed = df.withColumn("__bag", bag)
    values = {}
    for k in keys:
        value = F.get(F.col("__bag"), F.lit(0))[k]
        values[k] = value if default is None else F.coalesce(value, F.lit(default))
    return parsed.withColumns(values).drop("__bag")


def extract(df: DataFrame, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Null-safe extraction of nested fields: ``{name: "a.b.c"}``."""
    return df.select(*keep, *[F.col(path).alias(name) for name, path in paths.items()])


# Output column and document path of a tracked issue.
ISSUE_PATHS = {
    "key": "key",
    "summary": "fields.summary",
    "resolution": "fields.resolution.name",
    "role": "fields.customfield_10742",
    "assignee": "fields.assignee.displayName",
    "creator": "fields.creator.displayName",
    "issuetype": "fields.issuetype.name",
    "defect_severity": "fields.customfield_10073.value",
    "status": "fields.status.name",
    "status_catergory": "fields.status.statusCategory.name",
    "priority": "fields.priority.name",
    "organisation": "fields.customfield_10273.value",
    "division": "fields.customfield_10275.value",
    "squad": "fields.customfield_10001.name",
    "development_bug": "fields.customfield_10311",
    "environment": "fields.environment",
    "device": "fields.customfield_10076.value",
    "created": "fields.created",
    "updated": "fields.updated",
}
# Columns that are blank text instead of null when absent.
ISSUE_BLANKS = ("defect_severity", "development_bug")


def path_ddl(paths: Sequence[str], leaf: str = "string") -> str:
    """DDL of the smallest struct that holds all dotted paths."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def render(node: dict, top: bool) -> str:
        mark = " " if top else ": "
        fields = ", ".join(
            f"`{name}`{mark}{render(sub, False) if sub else leaf}" for name, sub in node.items()
        )
        return fields if top else f"struct<{fields}>"

    return render(tree, True)


def issue_rows(df: DataFrame, document: str, paths: Mapping[str, str] = ISSUE_PATHS) -> DataFrame:
    """Issue documents (JSON text) to one flat row each, with a repeatable row id."""
    doc = F.from_json(F.col(document), path_ddl(list(paths.values())))
    rows = extract(df.select(doc.alias("doc")), {n: f"doc.{p}" for n, p in paths.items()})
    blanks = {c: F.coalesce(F.col(c), F.lit("")) for c in ISSUE_BLANKS if c in rows.columns}
    identity = F.sha2(F.concat_ws("\u001f", F.col("key"), F.col("updated")), 256)
    return rows.withColumns(blanks).withColumn("id", identity)


def unwrap(
    df: DataFrame,
    payload: str,
    ddl: str,
    path: str,
    item: str = "record",
    where: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse a JSON envelope, one row per element of the array at ``path``.

    Unparseable envelopes, and envelopes without the array, give no rows.
    """
    body = df.select(*keep, F.from_json(F.col(payload), ddl).alias("body"))
    rows = body.select(*keep, F.explode(F.col(f"body.{path}")).alias(item))
    return rows if where is None else rows.where(where)


def pick_objects(
    df: DataFrame, payload: str, objects: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Chosen top-level objects ``{name: type}`` of a JSON response as columns.

    Only the chosen objects are parsed; absent ones are null.
    """
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in objects.items())
    body = df.select(*keep, F.from_json(F.col(payload), ddl).alias("body"))
    return body.select(*keep, *[F.col("body")[name].alias(name) for name in objects])


# Shape of an object-created notification and its accepted source.
ARRIVAL_DDL = (
    "Records array<struct<eventSource: string, "
    "s3: struct<bucket: struct<name: string>, object: struct<`key`: string>>>>"
)
ARRIVAL_SOURCE = "aws:s3"


def arrivals(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """Object-created notifications to (bucket, key) rows; test and foreign events drop out.

    A key that cannot be decoded is null: give the rows a rule and a quarantine.
    """
    rows = unwrap(
        df, payload, ARRIVAL_DDL, "Records", "record",
        F.col("record.eventSource") == ARRIVAL_SOURCE, keep,
    )
    return rows.select(
        *keep,
        F.col("record.s3.bucket.name").alias("bucket"),
        F.try_url_decode(F.col("record.s3.object.key")).alias("key"),
    )


def page_records(df: DataFrame, records: str, drop: Sequence[str] = ("attributes_",)) -> DataFrame:
    """Pages of record arrays to flat rows, without the columns of the given prefixes."""
    rows = df.select(F.explode(F.col(records)).alias("r")).select("r.*")
    return drop_prefixed(flatten(rows), *drop)


def flatten_json(df: DataFrame, column: str, sep: str = "_", max_items: int | Mapping[str, int] | None = None, broken: str | None = None) -> DataFrame:
    """Replace a column of JSON text by one column for each field that any document has.

    The shape is not declared: documents are read as variants, whose schemas Spark merges in one
    aggregate. A field has its values' common type; where rows disagree, it is text, a document as
    JSON. Names and arrays follow :func:`flatten`. What is no JSON gives nulls, and its text in ``broken``.
    Values that are no objects stand in a column named like the old one.
    """
    others = [c for c in df.columns if c != column]
    document = F.try_parse_json(F.col(f"`{column}`"))
    held = df.withColumn("__document", document)
    found = held.agg(F.schema_of_variant_agg("__document")).first()[0] or "VOID"
    # SQL types have other names for two of a variant's shapes; names stand in backticks where they are odd.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    parts[::2] = [re.sub(r"\bOBJECT(?=<)", "STRUCT", re.sub(r"\bVOID\b(?!:)", "STRING", p)) for p in parts[::2]]
    kind = "".join(parts)
    typed = F.try_variant_get("__document", "$", kind).alias(column)
    kept = [F.when(F.col("__document").isNull(), F.col(f"`{column}`")).alias(broken)] if broken else []
    flat = held.select(*[F.col(f"`{c}`") for c in others], typed, *kept)
    documents = flatten(flat, sep, max_items=max_items, only=[column])
    # Fields whose rows disagree are still variants.
    texts = {f.name for f in documents.schema if isinstance(f.dataType, T.VariantType) and f.name not in others}
    return documents.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in texts else F.col(f"`{c}`") for c in documents.columns])
