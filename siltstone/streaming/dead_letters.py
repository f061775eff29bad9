"""Files that cannot be read are set aside after some attempts, with their error; the stream goes on.

A truncated or damaged file fails the whole micro-batch that holds it, and the batch of a file stream
cannot be taken without it. So the stream here carries paths, and each batch reads its files itself. When
that fails, the files are looked at one by one, each failure is noted in a ledger and the batch is
tried again; after the last attempt it is written without the files that cannot be read. Their rows are
left out whole, never in part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.readers import FORMATS
from siltstone.streaming.arrivals import BROKEN, FILE, FILES_PER_BATCH

# Fixed value: deliveries of one message before it counts as dead.
ATTEMPTS = 10

_LEDGER = T.StructType([T.StructField(n, t) for n, t in (("file", T.StringType()), ("attempt", T.IntegerType()), ("error", T.StringType()))])


def _unreadable(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The files whose bytes cannot be read to their end, with the first line of the error."""
    found = {}
    for file in files:
        try:
            spark.read.text(file).agg(F.sum(F.length("value"))).collect()
        except Exception as exc:  # noqa: BLE001 - whatever a codec raises
            text = exc.getMessage() if isinstance(exc, PySparkException) and exc.getMessage() else str(exc)
            found[file] = text.strip().splitlines()[0][:500] if text.strip() else type(exc).__name__
    return found


def dead_letters(spark: SparkSession, ledger: str, attempts: int = ATTEMPTS) -> DataFrame:
    """(file, attempts, error) of the files that were set aside; none before the first failure."""
    rows = spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(ledger)
    failed = rows.groupBy("file").agg(F.max("attempt").alias("attempts"), F.max_by("error", "attempt").alias("error"))
    return failed.where(F.col("attempts") >= attempts)


def path_stream(spark: SparkSession, path: str, glob: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The paths of the files that arrive below ``path``; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(path).select("path")


def sifting(
    write: Callable[..., None], ledger: str, schema: T.StructType, fmt: str = "json.gz", attempts: int = ATTEMPTS
) -> Callable[..., None]:
    """A ``foreachBatch`` sink of a :func:`path_stream`: reads the files of a batch and passes their rows to ``write``.

    ``write`` is a sink such as :func:`siltstone.streaming.arrivals.batch_writer` with a quarantine; records that
    are broken inside a readable file go there. A batch has as many paths as the stream's limit allows. An
    error that no file explains fails the batch. A repeated batch replaces its entries in the ledger.
    """

    def read(spark: SparkSession, files: list[str]) -> DataFrame:
        source, options = FORMATS[fmt]
        full = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        rows = spark.read.format(source).schema(full).options(**{**options, "columnNameOfCorruptRecord": BROKEN}).load(files)
        return rows.withColumn(FILE, F.col("_metadata.file_path"))

    def attempt(batch: DataFrame, batch_id: int, run: str = "direct") -> None:
        spark = batch.sparkSession
        files = sorted(r["path"] for r in batch.select("path").collect())
        dead: dict[str, str] = {}
        for number in range(1, attempts + 1):
            try:
                write(read(spark, files), batch_id, run)
                return
            except Exception:
                dead = _unreadable(spark, files)
                if not dead:
                    raise
                rows = spark.createDataFrame([(f, number, e) for f, e in sorted(dead.items())], _LEDGER)
                rows.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/run={run}/batch_id={batch_id}/attempt_{number}")
        readable = [f for f in files if f not in dead]
        write(read(spark, readable) if readable else spark.createDataFrame([], schema), batch_id, run)

    return attempt
