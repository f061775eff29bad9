"""Splittable scans of JSON arrays and of CSV with line breaks in quotes.

Spark reads such a file in one task, because a byte range does not tell whether it begins inside quotes.
Here the file is read in byte ranges as text, cut at every ``}`` or line break into fragments, and a
byte range in blocks of fragments. Each block is worked out, without its text, for both possible
beginnings, outside and inside quotes; a table with one row for each block then composes them, in file
order, and says how each block really begins. A second read puts the fragments between two ends of
records together: those of one block where they lie, only what reaches over a block's border meets
its rest in a further, small exchange. No task holds more than a few blocks or a record.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import materialize

CORRUPT = "_corrupt_record"
_RANGE = ["__file", "__range"]

#: Bits of a fragment's place inside its task, as ``monotonically_increasing_id`` numbers rows.
_PLACE_BITS = 33
#: Bits of a fragment's place inside its block: a window holds a block, however large the byte range.
_BLOCK_BITS = 14


@contextmanager
def _at_least(spark: SparkSession, tasks: int | None) -> Iterator[None]:
    """Files are split into at least so many ranges, however small."""
    wanted = {} if tasks is None else {"spark.sql.files.minPartitionNum": str(tasks), "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _without_escapes(text: Column) -> Column:
    """The text without escaped backslashes and quotes."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))


def _opened(plain: Column) -> Column:
    """Braces opened outside quotes, in a text that begins outside."""
    return _count(F.regexp_replace(plain, '"[^"]*("|$)', ""), "{")


def _pieces(spark: SparkSession, path: str | list[str], separator: str, braces: bool) -> DataFrame:
    """The pieces of text between separators, in numbered order, with the block that each one lies in.

    ``__range`` is the byte where the range begins and the block's place in its task, which grows along
    the file.
    """
    read = spark.read.option("lineSep", separator).text(path)
    plain = _without_escapes(F.col("value"))
    zero = F.lit(0).cast("long")
    rows = read.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        # Grows along a range, as a task reads it.
        F.monotonically_increasing_id().alias("__at"),
        (_count(plain, '"') % 2).alias("__odd"),
        (_opened(plain) if braces else zero).alias("__open_0"),
        (_opened(F.concat(F.lit('"'), plain)) if braces else zero).alias("__open_1"),
    )
    block = F.shiftright(F.col("__at").bitwiseAND((1 << _PLACE_BITS) - 1), _BLOCK_BITS)
    return rows.withColumn("__range", F.shiftleft("__start", _PLACE_BITS - _BLOCK_BITS) + block).drop("__start")


def fragments(spark: SparkSession, path: str | list[str], separator: str, braces: bool) -> DataFrame:
    """The pieces of text between separators, with what is known of each block for both ways it may begin.

    For beginning h (0 outside, 1 inside quotes): ``inside_h`` after the piece, ``depth_h`` of braces
    after it, relative to the block's beginning, and ``__ends_end_h``, whether a record ends with it. A
    record ends outside quotes at the least depth that the block reaches. Behind the last separator of a
    file a piece is left that is closed by nothing; ``__rest_end_h`` counts without a block's last piece.
    """
    return _marked(_pieces(spark, path, separator, braces), braces)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Dealt by the keys to all shuffle partitions: these rows pack so well that merged ones would not fit in memory."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _marked(pieces: DataFrame, braces: bool) -> DataFrame:
    rows = _dealt(pieces.drop("value"), *_RANGE)
    zero = F.lit(0).cast("long")
    along = Window.partitionBy(*_RANGE).orderBy("__at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("__after", F.sum("__odd").over(upto) % 2).withColumn("__last", F.lead("__at").over(along).isNull())
    for h in (0, 1):
        inside = (F.col("__after") + h) % 2
        began_inside = (F.col("__after") + F.col("__odd") + h) % 2
        step = F.when(began_inside == 1, F.col("__open_1")).otherwise(F.col("__open_0")) - F.when(inside == 0, 1).otherwise(0) if braces else zero
        rows = rows.withColumn(f"inside_{h}", inside).withColumn(f"__step_{h}", step)
    for h in (0, 1):
        rows = rows.withColumn(f"depth_{h}", F.sum(f"__step_{h}").over(upto))
    for h in (0, 1):
        outside = F.when(F.col(f"inside_{h}") == 0, F.col(f"depth_{h}"))
        rows = rows.withColumn(f"least_{h}", F.min(outside).over(whole))
        rows = rows.withColumn(f"least_rest_{h}", F.min(F.when(~F.col("__last"), outside)).over(whole))
    for h in (0, 1):
        for name, least in (("ends", f"least_{h}"), ("rest", f"least_rest_{h}")):
            end = F.when((F.col(f"inside_{h}") == 0) & (F.col(f"depth_{h}") == F.col(least)), 1).otherwise(0)
            rows = rows.withColumn(f"__{name}_end_{h}", end)
            rows = rows.withColumn(f"total_{name}_{h}", F.sum(f"__{name}_end_{h}").over(whole))
    kept = [*_RANGE, "__at", "__after", "__last"]
    return rows.select(*kept, *[f"{c}_{h}" for c in ("depth", "least", "least_rest", "total_ends", "total_rest") for h in (0, 1)])


def composed(pieces: DataFrame) -> DataFrame:
    """How each block begins: one row for each, from a running sum over the blocks of its file.

    ``way`` is 0 or 1, as outside or inside quotes; a record ends outside quotes at depth ``least``, null
    where none ends in the block, and ``total`` records do. ``open_range`` and ``open_number`` name the
    record that is open when the block begins.
    """
    last = pieces.where("__last")
    along = Window.partitionBy("__file").orderBy("__range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)

    def chosen(name: str) -> Column:
        return F.when(F.col("way") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    ranges = last.withColumn("way", F.coalesce(F.sum("__after").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("__depth", chosen("depth")).withColumn("depth", F.coalesce(F.sum("__depth").over(before), F.lit(0)))
    # What follows the last record closes nothing: there the depth seems to fall below 0.
    kind = F.when(F.col("depth") + chosen("least") == 0, "ends").when(F.col("depth") + chosen("least_rest") == 0, "rest")
    ranges = ranges.withColumn("__count", kind)

    def counted(ends: str, rest: str) -> Column:
        return F.when(F.col("__count") == "ends", chosen(ends)).when(F.col("__count") == "rest", chosen(rest))

    ranges = ranges.withColumn("least", counted("least", "least_rest"))
    ranges = ranges.withColumn("total", F.coalesce(counted("total_ends", "total_rest"), F.lit(0)))
    closed = F.when(F.col("total") > 0, F.struct(F.col("__range").alias("r"), F.col("total").alias("n")))
    ranges = ranges.withColumn("__open", F.last(closed, ignorenulls=True).over(before))
    return ranges.select(
        *_RANGE, "way", "least", "total",
        F.coalesce("__open.r", F.lit(-1).cast("long")).alias("open_range"), F.coalesce("__open.n", F.lit(0)).alias("open_number"),
        # Stands for file and range where each fragment carries it.
        F.monotonically_increasing_id().alias("__block"),
    )


def _joined(pieces: DataFrame, order: str, keys: Sequence[str], separator: str) -> DataFrame:
    """The texts of each key in order, as one."""
    together = pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("__texts"))
    return together.select(*keys, F.array_join("__texts.text", separator).alias("text"))


def _parts(pieces: DataFrame, ranges: DataFrame, separator: str, braces: bool) -> DataFrame:
    """The part of each record that lies in a block: all of it, where ``__whole``."""
    along = Window.partitionBy("__block").orderBy("__at")
    upto, before = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    known = ["__block", "way", *(["least"] if braces else [])]
    carried = ["__at", F.col("value").alias("text"), "__odd", *(["__open_0", "__open_1"] if braces else [])]
    met = _dealt(pieces.join(ranges.select(*_RANGE, *known), _RANGE).select(*known, *carried), "__block")
    met = met.withColumn("__inside", (F.sum("__odd").over(upto) + F.col("way")) % 2)
    ended = F.col("__inside") == 0
    if braces:
        opened = F.when((F.col("__inside") + F.col("__odd")) % 2 == 1, F.col("__open_1")).otherwise(F.col("__open_0"))
        met = met.withColumn("__step", opened - F.when(ended, 1).otherwise(0))
        met = met.withColumn("__depth", F.sum("__step").over(upto))
        ended &= F.col("__depth") == F.col("least")
    met = met.withColumn("__end", F.when(ended, 1).otherwise(0))
    met = met.withColumn("__number", F.coalesce(F.sum("__end").over(before), F.lit(0)))
    parts = _joined(met.select("__block", "__number", "__at", "text"), "__at", ["__block", "__number"], separator)
    own = F.col("__number") > 0
    return parts.join(ranges, "__block").select(
        *_RANGE,
        F.when(own, F.col("__range")).otherwise(F.col("open_range")).alias("__begin"),
        F.when(own, F.col("__number")).otherwise(F.col("open_number")).alias("__record"),
        (own & (F.col("__number") < F.col("total"))).alias("__whole"),
        "text",
    )


def records(spark: SparkSession, path: str | list[str], separator: str, braces: bool, min_tasks: int | None = None) -> DataFrame:
    """(file, first, text): the records of all files, with whether each is the first of its file.

    They are written once, so that all that reads them costs one more read of what was written.
    """
    with _at_least(spark, min_tasks):
        # One listing of the files, so that both reads cut them alike.
        pieces = _pieces(spark, path, separator, braces)
        # Written, so that Spark knows its size: one row for each block.
        ranges = materialize(composed(_marked(pieces, braces)), "ranges")
        parts = materialize(_parts(pieces, ranges, separator, braces), "records")
    edges = _joined(parts.where(~F.col("__whole")), "__range", ["__file", "__begin", "__record"], separator)
    found = parts.where("__whole").select(*edges.columns).unionByName(edges)
    first = (F.col("__begin") == -1) & (F.col("__record") == 0)
    return found.select(F.col("__file").alias("file"), first.alias("first"), "text")


def _with_corrupt(schema: T.StructType, corrupt: str) -> T.StructType:
    return schema if corrupt in schema.names else T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType, min_tasks: int | None = None, corrupt: str = CORRUPT
) -> DataFrame:
    """The objects of JSON array files, each file read by many tasks.

    The columns are those of ``schema`` and ``corrupt``: the text of what is no object of this schema, null
    for all others. Quotes, braces and line breaks inside texts are theirs. Empty files and arrays have
    no rows. Files are UTF-8 and not compressed.
    """
    found = records(spark, path, "}", True, min_tasks)
    # Between two objects stand blanks and a comma, before the first one a bracket, after the last one its end.
    body = F.regexp_replace("text", "^[\\s\\uFEFF,\\[]+", "")
    objects = found.select(body.alias("text")).where(~F.col("text").rlike("^[\\s\\],]*$"))
    full = _with_corrupt(schema, corrupt)
    parsed = F.from_json(F.concat("text", F.lit("}")), full, {"columnNameOfCorruptRecord": corrupt})
    return objects.select(parsed.alias("r")).select("r.*")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    min_tasks: int | None = None,
    corrupt: str = CORRUPT,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The records of CSV files whose quoted values may hold line breaks, each file read by many tasks.

    Quotes inside a quoted value are doubled or follow a backslash; a value that holds a quote must be
    quoted. With ``header``, the first record of every file must be the names of ``schema``, or the read
    fails. Columns and ``corrupt`` as in :func:`read_json_array`; blank lines are no records.
    """
    found = records(spark, path, "\n", False, min_tasks)
    text = F.regexp_replace(F.regexp_replace("text", "\\r$", ""), "^\\uFEFF", "")
    lines = found.select("first", text.alias("text")).where("trim(text) <> ''")
    if header:
        names = F.from_csv("text", ", ".join(f"`{i}` string" for i in range(len(schema))))
        given = F.array(*[names[str(i)] for i in range(len(schema))])
        right = given == F.array(*[F.lit(n) for n in schema.names])
        checked = F.assert_true(F.coalesce(right, F.lit(False)), F.concat(F.lit("header does not name the declared columns: "), "text"))
        lines = lines.where(F.when(F.col("first"), checked.isNotNull()).otherwise(True))
    full = _with_corrupt(schema, corrupt)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    how = {"escape": "\\", "columnNameOfCorruptRecord": corrupt, **(options or {})}
    return lines.select(F.from_csv("text", ddl, how).alias("r")).select("r.*")


def read_csv_by_name(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    file_column: str,
    min_tasks: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The named columns of CSV files of any column order, as text, and the file of each row.

    Every file's first record names its columns; names are compared without case, and a column that a
    file lacks is null. The headers, one row for each file, come out of the same read as the records.
    """
    found = records(spark, path, "\n", False, min_tasks)
    text = F.regexp_replace(F.regexp_replace("text", "\\r$", ""), "^\\uFEFF", "")
    lines = found.select("file", "first", text.alias("text")).where("trim(text) <> ''")
    how = {"escape": "\\", **(options or {})}
    # No file has more columns than its header has commas, and one.
    most = lines.where("first").agg(F.max(_count(F.col("text"), ","))).first()[0]
    width = 1 + (most or 0)
    ddl = ", ".join(f"`{i}` string" for i in range(width))

    def cells() -> Column:
        parsed = F.from_csv("text", ddl, how)
        return F.transform(F.array(parsed), lambda r: F.array(*[r[str(i)] for i in range(width)]))

    # Written, so that Spark knows its size: one row for each file.
    heads = materialize(lines.where("first").select("file", F.transform(F.get(cells(), F.lit(0)), F.lower).alias("names")), "csv-headers")
    rows = lines.where(~F.col("first")).select("file", F.get(cells(), F.lit(0)).alias("cells")).join(heads, "file")
    named = [F.try_element_at("cells", F.nullif(F.array_position("names", c.lower()), F.lit(0)).cast("int")).alias(c) for c in columns]
    return rows.select(*named, F.col("file").alias(file_column))
