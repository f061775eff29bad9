"""Column profiles kept per file and merged by addition, so that only new files are ever profiled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.joins import anti
from siltstone.operators.profile import MEASURES, NATIVE_TYPES, QUICK, RULES, TIMES, _facts, _measures
from siltstone.session import materialize
from siltstone.sources import versions
from siltstone.sources.readers import FORMATS, list_files

_LEAST, _MOST = ("min_int",), ("max_int",)


def _by_file(df: DataFrame, names: list[str], measures: Sequence[str]) -> DataFrame:
    facts = df.select(
        F.col("_metadata.file_path").alias("file"),
        *[expr.alias(f"{i}_{fact}") for i, name in enumerate(names) for fact, expr in _facts(F.col(f"`{name}`")).items()],
    )
    wide = facts.groupBy("file").agg(
        *[
            expr.cast("long").alias(f"{i}_{measure}")
            for i in range(len(names))
            for measure, expr in _measures(*[F.col(f"`{i}_{fact}`") for fact in ("text", "whole", "stamp")]).items()
            if measure in measures
        ]
    )
    rows = [F.struct(F.lit(name).alias("column_name"), *[F.col(f"`{i}_{m}`").alias(m) for m in measures]) for i, name in enumerate(names)]
    return wide.select("file", F.inline(F.array(*rows)))


def profile_by_file(df: DataFrame) -> DataFrame:
    """One row for each file and column of a table just read: its type and measures.

    Time layouts are tried in columns of which some file may hold nothing but times; elsewhere the
    measures of times are 0, as one value that is none decides the column.
    """
    quick = materialize(_by_file(df, df.columns, QUICK), "file-profiles")
    open_ones = [r[0] for r in quick.where("n_set > 0 and n_marked = n_set").select("column_name").distinct().collect()]
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    typed = quick.withColumn("type", types[F.col("column_name")])
    if open_ones:
        names = [c for c in df.columns if c in open_ones]
        typed = typed.join(_by_file(df, names, TIMES), ["file", "column_name"], "left")
    times = [(F.coalesce(m, F.lit(0).cast("long")) if open_ones else F.lit(0).cast("long")).alias(m) for m in TIMES]
    return typed.select("file", "column_name", "type", *QUICK, *times)


def profile_new_files(
    spark: SparkSession, path: str, root: str, batch: str, fmt: str = "parquet", glob: str | None = None, options: Mapping[str, str] | None = None
) -> int:
    """Profile the files below ``path`` that the state at ``root`` does not know; returns the state's version.

    The files of one run share a schema; later runs may bring more columns or other types. Files without
    rows are known by their names alone. A batch that ran before does nothing.
    """
    done = versions.version_of(spark, root, batch)
    if done is not None:
        return done
    version = versions.latest(spark, root)
    known = versions.entries(spark, root)
    files = list_files(spark, path, glob).select(F.col("path").alias("listed"))
    fresh = files if known is None else anti(files, known.select("listed").where("listed is not null"), ["listed"])
    # The paths of a read are on the driver in any case: Spark lists files there.
    paths = sorted(r[0] for r in fresh.collect())
    source, defaults = FORMATS[fmt]
    if paths:
        rows = spark.read.format(source).options(**{**defaults, **(options or {})}).load(paths)
        profile_by_file(rows).write.mode("overwrite").parquet(f"{root}/profiles/version={version + 1}")
    versions.publish(spark.createDataFrame([(p,) for p in paths] or [(None,)], "listed string"), root, version + 1, batch)
    return version + 1


def merged_profile(spark: SparkSession, root: str) -> DataFrame:
    """One row per column over all known files, as :func:`siltstone.operators.profile.profile` of their rows.

    ``types`` lists the types that the files had the column in. A column that a file lacks counts there
    for nothing.
    """
    known = versions.entries(spark, root).select("version").distinct()
    stored = spark.read.parquet(f"{root}/profiles").withColumn("version", F.col("version").cast("long"))
    counted = stored.join(known, "version", "left_semi")
    sums = [F.sum(m).alias(m) for m in MEASURES if m not in (*_LEAST, *_MOST)]
    ends = [F.min(m).alias(m) for m in _LEAST] + [F.max(m).alias(m) for m in _MOST]
    types = F.array_sort(F.collect_set("type")).alias("types")
    return counted.groupBy("column_name").agg(types, *sums, *ends).select("column_name", "types", *MEASURES)


def inferred_schema(spark: SparkSession, root: str, rules: str = "content") -> dict[str, str]:
    """Declared types of all known files, by the rules of :func:`siltstone.operators.profile.infer_schema`.

    A new file widens a type where its values need it. One row for each column reaches the driver.
    """
    judge = RULES[rules]
    found = {}
    for p in materialize(merged_profile(spark, root), "merged-profile").orderBy("column_name").collect():
        by_text = rules != "dates" or "string" in p["types"]
        found[p["column_name"]] = judge(p, p["column_name"]) if by_text else NATIVE_TYPES.get(p["types"][0], "string")
    return found
