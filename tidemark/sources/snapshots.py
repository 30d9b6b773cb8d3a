"""Dated snapshots of a table: one folder a day, found by name, replaced as a whole."""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import exists


def as_day(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


class SnapshotStore:
    """Snapshots under ``path``, a folder ``date_col=yyyy-mm-dd`` each.

    Days are listed from the folder names alone, and a read opens the folders of the wanted days only, so the cost of
    a comparison of two days doesn't grow with the history.
    """

    def __init__(self, spark: SparkSession, path: str, date_col: str):
        self.spark, self.path, self.date_col = spark, path.rstrip("/"), date_col

    def _folder(self, day: date) -> str:
        return f"{self.path}/{self.date_col}={day.isoformat()}"

    def add(self, df: DataFrame, day: date | str) -> None:
        """Store ``df`` as the snapshot of ``day``; a second run for the day replaces it, also by no rows."""
        df.drop(self.date_col).write.mode("overwrite").parquet(self._folder(as_day(day)))

    def dates(self, upto: date | str | None = None) -> list[date]:
        """Stored days in order, those up to ``upto`` only; a snapshot that was never finished is no stored day."""
        if not exists(self.spark, self.path):
            return []
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [unquote(s.getPath().getName()) for s in fs.listStatus(root) if s.isDirectory()]
        days = sorted(date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{self.date_col}="))
        done = [d for d in days if exists(self.spark, f"{self._folder(d)}/_SUCCESS")]
        return [d for d in done if upto is None or d <= as_day(upto)]

    def read(self, *days: date | str) -> DataFrame:
        """Rows of the given days, with their day as last column; of all stored days without any."""
        wanted = [as_day(d) for d in days] or self.dates()
        if not wanted:
            raise ValueError(f"no snapshots under {self.path}")
        df = self.spark.read.option("basePath", self.path).parquet(*map(self._folder, wanted))
        return df.withColumn(self.date_col, F.col(self.date_col).cast("date"))

    def latest(self, n: int = 1, upto: date | str | None = None) -> DataFrame:
        """Rows of the ``n`` latest days up to ``upto``."""
        days = self.dates(upto)[-n:]
        if not days:
            raise ValueError(f"no snapshots up to {upto} under {self.path}")
        return self.read(*days)
