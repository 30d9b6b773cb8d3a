"""Writing results: append what is new, overwrite a named output, export text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import c
from tidemark.functions.spread import latest


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of ``source`` whose keys are not in ``target``; of repeated keys the row that is last by ``order``.

    Without an order the largest row by all other columns is taken, so a rerun stores the same values.
    """
    rest = order or [x for x in source.columns if x not in keys]
    once = latest(source, keys, rest) if rest else source.select(*keys).distinct()
    return once.join(target.select(*keys).distinct(), keys, "left_anti").select(*source.columns)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def append_new(spark: SparkSession, path: str, source: DataFrame, keys: list[str], order: list[str] | None = None) -> None:
    """Insert-if-absent into a Parquet table; the first call creates it."""
    target = spark.read.parquet(path) if exists(spark, path) else source.limit(0)
    new_rows(target, source, keys, order).write.mode("append").parquet(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a named output and return a reader of it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_snapshot(df: DataFrame, path: str, date_col: str) -> None:
    """Add one dated snapshot; a second run for the same date replaces that date only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def export_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Text export with header.  Reports of a few rows may ask for a single file."""
    flat = df.select(
        *[
            F.to_json(c(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else c(f.name)
            for f in df.schema.fields
        ]
    )
    out = flat.coalesce(1) if single_file else flat
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    out.write.mode("overwrite").options(header="true", timestampNTZFormat=stamp).csv(path)


def run_in_order(*steps: Callable[[], object]) -> list[object]:
    """Dependent loads: each step starts when the one before has finished."""
    return [step() for step in steps]
