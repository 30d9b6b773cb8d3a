"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20
_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; a local folder only on a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tidemark-llm-")
        _own[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/llm/{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, on either side of a Python worker, unless the session has its own bound."""
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # the default
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


def stash(frame: DataFrame, fmt: str = "parquet", **options) -> DataFrame:
    """Write a result, drop the shuffle files behind it, and read it back: short lineage that outlives executors."""
    spark = frame.sparkSession
    path = folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    small_batches(spark)
    try:
        frame.write.format(fmt).options(**options).save(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.format(fmt).schema(frame.schema).load(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
