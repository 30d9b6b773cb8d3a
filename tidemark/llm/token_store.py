"""Token ids of a corpus in ORC files, in order of document ids.

Documents are dealt out by ranges of their id, encoded, and written one row a document: ids as a list of
integers, which ORC stores as run lengths and packed deltas. Every stripe has row indexes, and Bloom filters
on doc_id, so readers work stripe by stripe, and a lookup of a few documents skips the others from metadata.
Each file holds one shard; the place of a shard among all ids follows from the sums of the shards before it.

Null text is empty: such a document is its end id alone. Null ids come first. Rows that repeat an id are
documents of their own, in order of the text's CRC and then of the input part they came from; that part is
also a key of the ranges, so that an id with very many rows is spread over shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.packing import BLOCK_BYTES, _slabs
from tidemark.llm.shared import CLEANUP, folder, table
from tidemark.llm.tokens import encoder

END_ID = 0
STORED = "doc_id long, shard int, row int, at long, n_tokens int, ids array<int>"
ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}


def _encoded(path: str, end_id: int, lower: bool) -> Callable:
    """mapInArrow function: sorted (doc_id, text) rows to stored rows; at counts the shard's ids before a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, row, at, ids_of = TaskContext.get().partitionId(), 0, 0, encoder(path, lower)
        for batch in batches:
            for slab in _slabs(batch, BLOCK_BYTES):
                ids, offsets = ids_of.encode(slab.column(slab.schema.get_field_index("text")), end_id)
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        slab.column(slab.schema.get_field_index("doc_id")),
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(np.arange(row, row + n, dtype=np.int32)),
                        pa.array(offsets[:-1] + at),
                        pa.array(np.diff(offsets).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32))),
                    ],
                    STORED.replace("array<int>", "").replace(" long", "").replace(" int", "").replace(" ", "").split(","),
                )
                row, at = row + n, at + int(offsets[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, lower: bool = False) -> None:
    """Encode documents and write them as ORC in order of doc_id."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.crc32(text).alias("h"), F.spark_partition_id().alias("part"))
    order = [F.col("doc_id").asc_nulls_first(), "h", "part"]
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        stored.mapInArrow(_encoded(tokenizer, end_id, lower), STORED).write.options(**ORC).orc(path)
    finally:
        spark.conf.set(CLEANUP, before)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids, as stored."""
    stored = spark.read.schema(STORED).orc(path)
    # a row a shard: as many as there were shuffle partitions
    sums = stored.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base"))
    rows = stored.join(F.broadcast(bases), "shard")
    return rows.select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def ids_crc32(ids: pa.Array) -> pa.Array:
    """CRC of a list of ids as unsigned little-endian 32-bit integers."""
    values, at = repeats.lists(ids)
    raw = values.astype("<i4", copy=False)
    return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = folder(spark)
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.arrow_udf(ids_crc32, "long")("ids").alias("ids_crc32"))
