"""Intermediate results written where all executors can read them, so that plans stay short and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the session; only a local master may do without."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        folder = _own_folder.setdefault(app, "") or tempfile.mkdtemp(prefix="tidemark-")
        _own_folder[app] = folder
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/steps/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
