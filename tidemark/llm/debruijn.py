"""Removal of long word sequences that occur more than once, by De Bruijn compaction.

Runs of ``window`` words are the edges of a De Bruijn graph over the corpus. Consecutive edges that share the
smallest word k-gram hash form a path, which travels as one row (node: the k-gram, path: a hash of its words).
A node all of whose paths agree does not branch: the path is compacted, and the number of its copies answers
for every edge on it. Nodes that branch keep one path of each content; those are opened into single edges,
which are counted and traced back to their source coordinates.

Equal paths of one block meet before the shuffle, so a passage with many copies sends one row a block.

Null text has no words. Rows with equal id and text are one document: they get the same answer and don't
count as each other's copy. A null doc_id is an id like any other. Columns besides doc_id and text are carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.repeats import GLOBAL, SURE
from tidemark.llm.shared import stash, table

WINDOW = 35
GRAM = 10
EDGE = "edge long, doc long, h long, lo int, copies int"
PLACE = ["doc", "h", "lo", "n"]
KEPT = "n_words:long,n_removed:long,kept:string"


def _edges(length: int, block: int = 100_000) -> Callable:
    """mapInArrow function: the edges of the open paths of a text, as hashes with their source coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = rolling.text_column(batch, "text")
            doc, h = rolling.column(batch, "doc"), rolling.column(batch, "h")
            starts, ends, words = rolling.words_of(data, offsets)
            units = rolling.word_hashes(data, starts, ends)
            spots, at = repeats.lists(batch.column(batch.schema.get_field_index("spots")))
            copies, _ = repeats.lists(batch.column(batch.schema.get_field_index("copies")))
            rows: list[np.ndarray] = []
            held = 0
            for i in range(batch.num_rows):
                sums = rolling.prefix(units[words[i] : words[i + 1]])
                own = spots[at[i] : at[i + 1]]
                lo, n = own >> 32, own & 0xFFFFFFFF
                start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                edge = rolling.slices(sums, start, start + length).view(np.int64)
                same = [np.full(len(start), doc[i]), np.full(len(start), h[i], np.int64)]
                rows.append(np.stack([edge, *same, start, np.repeat(copies[at[i] : at[i + 1]], n)]))
                held += len(start)
                if held > block or i == batch.num_rows - 1:
                    full = np.concatenate(rows, axis=1)
                    narrow = [pa.array(x.astype(np.int32)) for x in full[3:]]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, full[:3]), *narrow], ["edge", "doc", "h", "lo", "copies"])
                    rows, held = [], 0

    return run


def _counted(rows: DataFrame, *key: str) -> DataFrame:
    """One row a key: whether it has two places at least, and the place that speaks for it."""
    place = F.xxhash64("doc", "h", "lo")
    return (
        rows.groupBy(*key)
        .agg(F.min(place).alias("speaker"), F.max(place).alias("last"), F.max("copies").alias("most"))
        .select(*key, "speaker", ((F.col("speaker") != F.col("last")) | (F.col("most") > 1)).alias("repeated"))
    )


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, h, lo, n: starts of all word windows that start at two places at least."""
    texts = repeats.keyed(docs)
    records = stash(texts.mapInArrow(repeats.span_records(window, min(GRAM, window), words=True), repeats.SCHEMA))
    rows = records.where(F.col("kind") == GLOBAL)
    paths = _counted(rows, "anchor", "content")
    nodes = paths.groupBy("anchor").agg((F.min("content") != F.max("content")).alias("branches"))
    # unrepeated paths of nodes that don't branch end here: most of the corpus
    decided = paths.join(nodes, "anchor").where("repeated OR branches")
    traced = stash(
        rows.join(decided, ["anchor", "content"])
        .withColumn("speaks", F.xxhash64("doc", "h", "lo") == F.col("speaker"))
        .where("repeated OR speaks")
        .select(*PLACE, "repeated", (F.col("branches") & F.col("speaks")).alias("open"))
    )
    spot = F.shiftleft(F.col("lo").cast("long"), 32).bitwiseOR(F.col("n").cast("long")).alias("spots")
    opened = (
        traced.where("open")
        .groupBy("doc", "h")
        .agg(F.collect_set(F.struct(spot, F.when(F.col("repeated"), 2).otherwise(1).cast("long").alias("copies"))).alias("own"))
        .select("doc", "h", "own.spots", "own.copies")
    )
    edges = stash(texts.join(opened, ["doc", "h"]).mapInArrow(_edges(window), EDGE))
    twice = _counted(edges, "edge").where("repeated").select("edge")
    single = stash(edges.where("copies = 1").join(twice, "edge").select("doc", "h", "lo", F.lit(1).alias("n")))
    return records.where(F.col("kind") == SURE).select(*PLACE).unionAll(traced.where("repeated").select(*PLACE)).unionAll(single)


def kept_words(text: Column, spots: Column, window: int) -> Column:
    """Struct n_words, n_removed, kept (the words that stay, joined by one space) of a text and its ranges."""

    @F.arrow_udf(f"struct<{KEPT}>")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        values, at = repeats.lists(ranges)
        total, removed, kept = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts.cast(pa.binary())):
            words = text.as_py().split()  # bytes split at exactly 0x20 and 0x09-0x0D
            total[i] = len(words)
            if at[i] < at[i + 1]:
                gone = repeats.covered(values[at[i] : at[i + 1]], window, len(words))
                removed[i] = gone.sum()
                words = list(compress(words, ~gone))
            kept.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(total), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"]
        )

    return cut(text, spots)


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (all columns of docs), n_words, n_removed and kept."""
    joined = repeats.with_ranges(docs, repeated_ranges(docs, window))
    return joined.select("row", kept_words(F.col("text"), F.col("spots"), window).alias("out")).select("row", "out.*")


def op2_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
