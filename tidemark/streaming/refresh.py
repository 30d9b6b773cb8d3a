"""Results that follow an ingest: partial aggregates by batch, merged when they are read.

Each micro-batch is reduced to one row per key and written under its batch number, so a batch that is retried after a
failure replaces its own rows and nothing is counted twice.  A reader merges the partial rows: sums of sums and counts,
least of least, greatest of greatest.  The facts are never read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import exists
from tidemark.streaming.ingest import BATCH


def _value(x: Column | str) -> Column:
    return F.expr(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Totals:
    """What is kept for every key; each measure is a named value of a row, a column or SQL text.

    ``counts`` are conditions, or True for all rows.
    """

    keys: dict[str, Column | str]
    sums: dict[str, Column | str] = field(default_factory=dict)
    counts: dict[str, Column | str | bool] = field(default_factory=dict)
    least: dict[str, Column | str] = field(default_factory=dict)
    greatest: dict[str, Column | str] = field(default_factory=dict)

    def of(self, rows: DataFrame) -> DataFrame:
        """One row per key from facts."""
        keys = [_value(x).alias(name) for name, x in self.keys.items()]
        return rows.groupBy(*keys).agg(
            *(F.sum(_value(x)).alias(n) for n, x in self.sums.items()),
            *((F.count(F.lit(1)) if x is True else F.count_if(_value(x))).alias(n) for n, x in self.counts.items()),
            *(F.min(_value(x)).alias(n) for n, x in self.least.items()),
            *(F.max(_value(x)).alias(n) for n, x in self.greatest.items()),
        )

    def merged(self, partial: DataFrame) -> DataFrame:
        """One row per key from rows that ``of`` gave; sums keep their type, so merging may be repeated."""
        kinds = dict(partial.dtypes)
        return partial.groupBy(*self.keys).agg(
            *(F.sum(n).cast(kinds[n]).alias(n) for n in [*self.sums, *self.counts]),
            *(F.min(n).alias(n) for n in self.least),
            *(F.max(n).alias(n) for n in self.greatest),
        )


def refresher(totals: dict[str, Totals]) -> Callable[[DataFrame, int], None]:
    """A refresh hook for ``ingest_stream`` that keeps the totals, each under its own folder."""

    def refresh(rows: DataFrame, number: int) -> None:
        for path, what in totals.items():
            what.of(rows).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return refresh


def refreshed(spark: SparkSession, path: str, totals: Totals) -> DataFrame:
    """The totals of all batches so far."""
    if not exists(spark, path):
        raise ValueError(f"no batch has been refreshed under {path}")
    return totals.merged(spark.read.option("basePath", path).parquet(path).drop(BATCH))


def compact(spark: SparkSession, path: str, totals: Totals, target: str) -> None:
    """Merge the batches so far into one folder of ``target``, where later batches go on.

    The old folder stays as it is until its readers have moved, so a failure on the way loses nothing.  Batches keep
    their numbers: the merged rows stand under the last one.
    """
    partial = spark.read.option("basePath", path).parquet(path)
    last = partial.agg(F.max(BATCH)).first()[0]
    totals.merged(partial.drop(BATCH)).write.mode("overwrite").parquet(f"{target}/{BATCH}={last}")
