"""Incremental file ingestion: new files in a folder become typed rows in a sink, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.files import FILE, apply_schema, as_struct, csv_options, text_schema

BATCH = "_batch"


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    sink_dir: str,
    checkpoint: str,
    *,
    glob: str | None = None,
    null_values=(),
    required=(),
    rejects_dir: str | None = None,
    refresh: Callable[[DataFrame, int], None] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load the files that arrived since the last run and stop.

    The checkpoint remembers which files were read.  Each micro-batch overwrites its own
    ``_batch=<n>`` partition, so a batch that is retried after a failure writes the same rows once.
    ``refresh`` runs after the write with the batch's typed rows, to update dependent outputs.
    """
    wanted = as_struct(schema)
    reader = spark.readStream.options(**csv_options(glob)).schema(text_schema(wanted))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.csv(source_dir).select("*", F.col("_metadata.file_path").alias(FILE))

    def write(batch: DataFrame, number: int) -> None:
        rows, rejects = apply_schema(batch, wanted, null_values, required)
        rows.write.mode("overwrite").parquet(f"{sink_dir}/{BATCH}={number}")
        if rejects_dir:
            rejects.write.mode("overwrite").parquet(f"{rejects_dir}/{BATCH}={number}")
        if refresh:
            refresh(spark.read.schema(rows.schema).parquet(f"{sink_dir}/{BATCH}={number}"), number)

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, sink_dir: str) -> DataFrame:
    """All rows loaded so far, without the bookkeeping columns."""
    return spark.read.option("basePath", sink_dir).parquet(sink_dir).drop(BATCH, FILE)
