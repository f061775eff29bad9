"""Which ids changed between two days, reading only where they did.

A day's ids are stored by hash bucket, with a digest of each bucket that does not depend on their order.
Two days are compared by their digests; ids are read of unequal buckets alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.sets import id_diff
from siltstone.sources.writers import write_table

BUCKETS = 256
BUCKET = "id_bucket"


def write_ids(df: DataFrame, key: str, root: str, day: str, buckets: int = BUCKETS) -> None:
    """Store the distinct ids of a day and their digests. Writing a day again replaces it."""
    bucket = F.pmod(F.xxhash64(F.lit(0), F.col(key)), F.lit(buckets))
    ids = df.select(F.col(key)).distinct().withColumn(BUCKET, bucket)
    write_table(ids, f"{root}/ids/day={day}", mode="overwrite", partition_by=[BUCKET], balanced=True)
    stored = df.sparkSession.read.schema(ids.schema).parquet(f"{root}/ids/day={day}")
    # Two sums of independent hashes and the count: changes that cancel out in all three do not occur.
    digests = stored.groupBy(F.col(BUCKET).cast("long").alias("bucket")).agg(
        F.count("*").alias("ids"),
        F.bit_xor(F.xxhash64(F.lit(1), F.col(key))).alias("first"),
        F.bit_xor(F.xxhash64(F.lit(2), F.col(key))).alias("second"),
        F.min(key).alias("least"),
    )
    digests.coalesce(1).write.mode("overwrite").parquet(f"{root}/digests/day={day}")


def unequal_buckets(spark: SparkSession, root: str, today: str, yesterday: str) -> list[int]:
    """Buckets whose digests differ, or that only one day has."""
    now, then = (spark.read.parquet(f"{root}/digests/day={day}") for day in (today, yesterday))
    both = now.alias("n").join(then.alias("t"), F.col("n.bucket") == F.col("t.bucket"), "full_outer")
    same = F.col("n.ids").eqNullSafe(F.col("t.ids")) & F.col("n.first").eqNullSafe(F.col("t.first")) & F.col("n.second").eqNullSafe(F.col("t.second"))
    return sorted(r[0] for r in both.where(~same).select(F.coalesce("n.bucket", "t.bucket")).collect())


def changed_ids(
    spark: SparkSession, root: str, key: str, today: str, yesterday: str, labelled: bool = True
) -> DataFrame:
    """Ids on one day only, as :func:`siltstone.operators.sets.id_diff` gives them. Both days must be stored."""
    buckets = [str(b) for b in unequal_buckets(spark, root, today, yesterday)]
    # A day without ids has digests, if only their schema, but no files.
    kind = spark.read.parquet(f"{root}/digests/day={today}").schema["least"].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField(BUCKET, T.StringType())])
    days = (spark.read.schema(schema).parquet(f"{root}/ids/day={day}") for day in (today, yesterday))
    now, then = (day.where(F.col(BUCKET).isin(buckets)).select(key) for day in days)
    return id_diff(now, then, key, labelled)
