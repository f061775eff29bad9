"""File arrival as a stream: each file once, each batch written once, bad rows set aside."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.readers import FORMATS
from siltstone.sources.writers import split_valid, write_table

# Objects per micro-batch and seconds between batches.
FILES_PER_BATCH = 50
BATCH_SECONDS = 30

# Columns of a record that could not be read: its text, and the file of every record.
BROKEN, FILE = "_broken_record", "_record_file"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json.gz",
    glob: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    keep_broken: bool = False,
) -> DataFrame:
    """Rows of the files that arrive under ``path``.

    ``keep_broken`` adds the text of records that cannot be read and the file of every record, in
    columns that :func:`batch_writer` moves to the quarantine (JSON and CSV).
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format: {fmt}")
    source, options = FORMATS[fmt]
    options = {k: v for k, v in options.items() if k != "mergeSchema"}
    if glob:
        options["pathGlobFilter"] = glob
    if keep_broken:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        options["columnNameOfCorruptRecord"] = BROKEN
    reader = spark.readStream.format(source).schema(schema).options(**options)
    rows = reader.option("maxFilesPerTrigger", files_per_batch).load(path)
    return rows.withColumn(FILE, F.col("_metadata.file_path")) if keep_broken else rows


def batch_writer(
    path: str,
    partition_by: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None,
    quarantine: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that a repeated batch cannot double.

    Each batch of a stream owns the folder ``run=<stream>/batch_id=<n>`` and replaces it whole, so a
    batch that is repeated on another day, with other partitions, leaves nothing behind, and a new
    stream over the same table does not touch the folders of an old one. Rows that break a rule, and
    records that could not be read, go to the quarantine table instead of failing the batch.
    """
    if rules and not quarantine:
        raise ValueError("rules need a quarantine: rows are never dropped")

    def write(batch: DataFrame, batch_id: int, run: str = "direct") -> None:
        def put(rows: DataFrame, target: str, parts: Sequence[str]) -> None:
            write_table(rows, f"{target}/run={run}/batch_id={batch_id}", mode="overwrite", partition_by=parts)

        tests = dict(rules or {})
        extra = [c for c in (BROKEN, FILE) if c in batch.columns]
        if BROKEN in extra:
            if not quarantine:
                raise ValueError("records that cannot be read need a quarantine")
            tests = {"readable": F.col(BROKEN).isNull()} | tests
        if not tests:
            put(batch.drop(*extra), path, partition_by)
            return
        kept = batch.persist()
        try:
            good, bad = split_valid(kept, tests)
            put(good.drop(*extra), path, partition_by)
            put(bad, quarantine, ())
        finally:
            kept.unpersist()

    return write


def _as_run(write: Callable[..., None], checkpoint: str) -> Callable[[DataFrame, int], None]:
    """The sink under the id that the checkpoint gave its stream."""

    def of_run(batch: DataFrame, batch_id: int) -> None:
        told = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"]
        write(batch, batch_id, json.loads(told)["id"])

    return of_run


def run_available(stream: DataFrame, write: Callable[..., None], checkpoint: str) -> None:
    """Process everything that has arrived and stop. A second run finds nothing new."""
    query = (
        stream.writeStream.foreachBatch(_as_run(write, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_continuous(
    stream: DataFrame, write: Callable[..., None], checkpoint: str, seconds: float = BATCH_SECONDS
):
    """Keep processing arrivals; returns the running query."""
    return (
        stream.writeStream.foreachBatch(_as_run(write, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )
