"""The newest (or oldest) row per key as a stored state, brought up to date by new log rows alone.

The state lies in hash buckets of the key. A run reduces its delta to one row per key, merges it with the
buckets that the delta touches and writes these; the others stay as they are. A manifest says in which
version each bucket was written last. The log of earlier days is never read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.keys import first_per_key, latest_per_key
from siltstone.session import materialize
from siltstone.sources import versions
from siltstone.sources.writers import write_table

#: Buckets of a state; a run rewrites those that its delta touches.
BUCKETS = 64
BUCKET = "key_bucket"


def _manifest(spark: SparkSession, root: str, version: int) -> dict[int, list[int]]:
    """Bucket numbers by the version that wrote them: one number for each bucket."""
    by_version: dict[int, list[int]] = {}
    if version:
        for bucket, written in versions.entries(spark, root).where(F.col("version") == version).select("bucket", "written").collect():
            if bucket is not None:
                by_version.setdefault(written, []).append(bucket)
    return by_version


def _read(spark: SparkSession, root: str, manifest: dict[int, list[int]]) -> DataFrame | None:
    parts = [
        spark.read.parquet(f"{root}/data/version={written}").where(F.col(BUCKET).isin([str(b) for b in buckets])).drop(BUCKET)
        for written, buckets in sorted(manifest.items())
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The state of the newest version, or of an earlier one."""
    number = versions.latest(spark, root) if version is None else version
    found = _read(spark, root, _manifest(spark, root, number))
    if found is None:
        raise ValueError(f"no state below {root}")
    return found


def advance(
    delta: DataFrame,
    root: str,
    batch: str,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    oldest: bool = False,
    buckets: int = BUCKETS,
) -> int:
    """Merge new log rows into the state and return its version.

    Rows are compared by ``order``, ``ties`` and all other columns, which is a total order: the state does not
    depend on how the log was cut into deltas, late rows lose to newer ones, and a row merged twice
    changes nothing. A batch that is in the log already is not read at all. The number of buckets
    belongs to the state: every run must name the same.
    """
    spark = delta.sparkSession
    done = versions.version_of(spark, root, batch)
    if done is not None:
        return done
    pick = first_per_key if oldest else latest_per_key
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))
    newest = materialize(pick(delta, keys, order, ties).withColumn(BUCKET, bucket), "delta")
    touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())
    version = versions.latest(spark, root)
    manifest = _manifest(spark, root, version)
    old = _read(spark, root, {v: kept for v, some in manifest.items() if (kept := [b for b in some if b in touched])})
    fresh = newest.drop(BUCKET)
    merged = fresh if old is None else pick(old.unionByName(fresh), keys, order, ties)
    if touched:
        write_table(merged.withColumn(BUCKET, bucket), f"{root}/data/version={version + 1}", mode="overwrite", partition_by=[BUCKET], balanced=True)
    written = {b: v for v, some in manifest.items() for b in some} | dict.fromkeys(touched, version + 1)
    rows = spark.createDataFrame(sorted(written.items()) or [(None, None)], "bucket long, written long")
    versions.publish(rows, root, version + 1, batch)
    return version + 1
