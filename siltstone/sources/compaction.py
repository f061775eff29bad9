"""Compaction of the small files of a table, the others left where they are.

The live files of a table are listed in a manifest. A run takes those below a size, packs neighbours of
one partition into groups of about the target size, and writes each group as one file. Files of the
target size keep their names; the new list counts once it is published, so readers of the old one
lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.session import materialize
from siltstone.sources import versions
from siltstone.sources.writers import TARGET_MB, WRITE_OPTIONS


def _manifest_root(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _listed(spark: SparkSession, base: str) -> DataFrame:
    """(path, bytes, base) of the Parquet files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
    return found.select("path", F.col("length").alias("bytes"), F.lit(base).alias("base"))


def _plain(path: Column) -> Column:
    """A path without its scheme; Spark's two file listings write that part differently."""
    return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/+", "/")


def register(spark: SparkSession, root: str) -> int:
    """List the Parquet files of a table as version 1 of its manifest."""
    versions.publish(_listed(spark, root.rstrip("/")), _manifest_root(root), 1, "register")
    return 1


def live_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, base) of the newest manifest."""
    where = _manifest_root(root)
    return versions.entries(spark, where).where(F.col("version") == versions.latest(spark, where)).select("path", "bytes", "base")


def _parts(files: DataFrame) -> Iterator[DataFrame]:
    by_base: dict[str, list[str]] = {}
    for path, base in files.select("path", "base").collect():
        by_base.setdefault(base, []).append(path)
    for base, paths in sorted(by_base.items()):
        yield files.sparkSession.read.option("basePath", base).parquet(*sorted(paths))


def read_live(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the live files. Spark keeps its file list on the driver, and so are these paths."""
    return reduce(DataFrame.unionByName, _parts(live_files(spark, root)))


def rewrite_groups(files: DataFrame, target: int) -> DataFrame:
    """(path, folder, group) of the files to rewrite: below half the target, and at least two in a group.

    Neighbours by path fill a group up to the target, by a running sum of sizes inside the folder.
    """
    small = files.where(F.col("bytes") * 2 < target).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    along = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    grouped = small.withColumn("group", F.floor(F.coalesce(F.sum("bytes").over(along), F.lit(0)) / target))
    together = Window.partitionBy("folder", "group")
    return grouped.withColumn("__files", F.count("*").over(together)).where("__files > 1").select("path", "base", "folder", "group")


def compact_small_files(spark: SparkSession, root: str, batch: str, partition_by: Sequence[str] = (), target_mb: float = TARGET_MB) -> int:
    """Rewrite groups of small files and publish the new list; returns its version.

    A batch that was published before does nothing. The read is limited to the chosen files by their
    paths, which their number bounds, and a group's rows, about the target in bytes, meet in one task.
    """
    where = _manifest_root(root)
    done = versions.version_of(spark, where, batch)
    if done is not None:
        return done
    version = versions.latest(spark, where) or register(spark, root)
    target = int(target_mb * (1 << 20))
    files = live_files(spark, root)
    groups = materialize(rewrite_groups(files, target), "rewrite-groups")
    count = groups.select("folder", "group").distinct().count()
    if count:
        folder = f"{root.rstrip('/')}/_compacted/version={version + 1}"
        # Spark names the file of a row in URL form.
        named = _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
        rows = reduce(DataFrame.unionByName, [part.withColumn("__path", named) for part in _parts(groups)])
        placed = rows.join(groups.select(_plain(F.col("path")).alias("__path"), "folder", "group"), "__path")
        dealt = placed.repartition(count, "folder", "group").drop("__path", "folder", "group")
        writer = dealt.write.mode("overwrite").options(**WRITE_OPTIONS["parquet"])
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        kept = files.join(groups.select("path"), "path", "left_anti").select("path", "bytes", "base")
        files = kept.unionByName(_listed(spark, folder))
    versions.publish(materialize(files, "manifest"), where, version + 1, batch)
    return version + 1
