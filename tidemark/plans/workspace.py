"""Lazy inputs plus named results that are written once and read by many queries.

The bank's marts form a chain: screening feeds the customer view, which feeds risk and
reports.  A `Workspace` builds each mart on first use, writes it as Parquet in the shared
checkpoint folder of the session, and hands the written table to every later consumer.  That
cuts lineage, survives executor loss, and keeps each downstream plan short.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.lineage import shared_folder
from tidemark.plans.tables import BASE, SPARK_TABLES, needs
from tidemark.sources.sinks import materialize

# inputs that join or bound the facts and that many queries read: each is derived once. The trades are not among them:
# they are wide joins of the two largest tables of which a query reads a few columns, so each takes only those through its join
SHARED_INPUTS = frozenset(
    (
        "in_customers in_accounts in_transactions in_watch_list in_exposed_persons "
        "in_hqla_holdings in_deposits in_loan_extracts"
    ).split()
)

# results that are joined for each reader from stored parts: a product of rows of which a reader needs a few columns
JOINED = frozenset(("customer_360", "customer_kinds"))

# inputs whose rows are long documents made from short rows: the short rows are dealt out first
LONG_INPUTS = frozenset(("in_messages", "in_loan_extracts"))
LONG_ROWS = 50_000


class Workspace:
    _open: dict[tuple[str, str], Workspace] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, marts: dict[str, Callable[[Workspace], DataFrame]], folders=None):
        self.spark = spark
        self.folders: dict[str, list[str]] = folders or {}  # columns by which a mart is stored
        self.sf_dir = str(sf_dir).rstrip("/")
        self.marts = marts
        key = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{key}"
        self._frames: dict[str, DataFrame] = {}
        self._paths = 0

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, marts, folders=None) -> Workspace:
        key = (spark.sparkContext.applicationId, str(sf_dir))
        found = cls._open.get(key)
        if found is None or found.spark is not spark:
            found = cls._open[key] = cls(spark, sf_dir, marts, folders)
        return found

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def __call__(self, *names: str) -> list[DataFrame]:
        return [self[n] for n in names]

    def _load(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in SPARK_TABLES:
            sql = SPARK_TABLES[name]
            text = re.sub(r"\{(\w+)\}", "\x01\\1\x02", sql).replace("{", "{{").replace("}", "}}")
            text = text.replace("\x01", "{").replace("\x02", "}")
            deal = self._dealt if name in LONG_INPUTS else self.__getitem__
            frame = self.spark.sql(text, **{n: deal(n) for n in needs(sql)})
            return self.written(name, frame) if name in SHARED_INPUTS else frame
        built = self.marts[name](self)
        return built if name in JOINED else self.written(name, built, self.folders.get(name))

    def _dealt(self, name: str) -> DataFrame:
        """A base table in parts of bounded size, as a file may hold all of it in one row group."""
        df = self[name]
        parts = max(self.spark.sparkContext.defaultParallelism, -(-df.count() // LONG_ROWS))
        return df.repartition(parts, *df.columns)

    def path(self, name: str) -> str:
        """A new folder in the shared area for files that a query writes itself."""
        self._paths += 1
        return f"{self.root}/files/{name}-{self._paths}"

    def written(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return materialize(df, f"{self.root}/{name}", partition_by)
