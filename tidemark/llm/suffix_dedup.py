"""Removal of long byte strings that occur earlier, by longest previous factors.

In the suffix order of a corpus, suffixes that share ``min_bytes`` bytes lie side by side. The longest
previous factor of a suffix reaches ``min_bytes`` exactly if its previous or next smaller position (the
nearest neighbours in suffix order that start earlier) lies in the same run of common prefixes. Ties are
ordered by place here, so within a run the previous smaller position is the left neighbour. Every byte of
the first ``min_bytes`` bytes of such a suffix goes; the first occurrence of each string stays.

The suffix order is built in parts that never separate suffixes with ``min_bytes`` common bytes:

1. Suffixes are dealt out by the smallest k-gram hash of their first ``min_bytes`` bytes. Neighbouring
   suffixes with the same key form a span and travel as one row. Spans of equal content are equal runs of
   suffixes: all but the earliest have a previous factor at once.
2. Keys whose spans all agree are settled. The earliest spans of the others are cut from their texts and
   dealt again by a longer k-gram, which leaves few of them.
3. What is left is sorted as real suffixes and compared with its neighbours byte by byte.

Equal spans of one block meet before the shuffle, so a passage with many copies sends one row a block.

Null text is empty. A null doc_id comes before all others. Rows with equal id and text are one document:
each is returned with the same answer and none counts as the other's copy. Rows with one id but different
texts are ordered by a hash of the text. Columns besides doc_id and text are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.repeats import GLOBAL, SURE
from tidemark.llm.shared import stash, table

MIN_BYTES = 100
#: k-grams of the two passes, as shares of min_bytes.
GRAMS = (0.32, 0.84)
OPEN = 2
CUT = "doc long, h long, base int, text binary"
SUFFIX = "key long, suffix binary, doc long, h long, lo int, kind int"
KEPT = "n_bytes:long,n_removed:long,n_spans:long,kept"


def _settled(records: DataFrame) -> DataFrame:
    """Ranges of suffixes with a previous factor (SURE), and earliest spans of keys with several contents (OPEN)."""
    key = Window.partitionBy("anchor")
    run = Window.partitionBy("anchor", "content").orderBy("doc", "h", "lo").rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct("doc", "h", "lo")
    kind = (
        F.when((F.col("kind") == SURE) | (place != F.col("earliest")), SURE)
        .when(F.col("one") != F.col("other"), OPEN)
        .otherwise(GLOBAL)
    )
    return stash(
        records.withColumn("earliest", F.first(place).over(run))
        .withColumn("one", F.min("content").over(key))
        .withColumn("other", F.max("content").over(key))
        .select("doc", "h", "base", "lo", "n", kind.alias("kind"))
        .where(F.col("kind") != GLOBAL)
    )


def _cut(length: int) -> Callable:
    """mapInArrow function: the bytes of the open ranges of a text, with the place of their first byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = rolling.text_column(batch, "text")
            doc, h, base = (rolling.column(batch, c) for c in ("doc", "h", "base"))
            spots, at = repeats.lists(batch.column(batch.schema.get_field_index("spots")))
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            lo = spots >> 32
            begin = offsets[row] + lo - base[row]
            end = begin + (spots & 0xFFFFFFFF) - 1 + length
            # batches of bounded size: the pieces of one text may be longer than the text
            for part in np.array_split(np.arange(len(row)), max(1, int((end - begin).sum()) >> 24)):
                cut = [data[a:b].tobytes() for a, b in zip(begin[part], end[part], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row[part]]), pa.array(h[row[part]]), pa.array(lo[part].astype(np.int32)), pa.array(cut, pa.binary())],
                    ["doc", "h", "base", "text"],
                )

    return run


def _suffixes(length: int, block: int = 100_000) -> Callable:
    """mapInArrow function: the suffixes of the open pieces, each as its first length bytes; equal ones of a block meet here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = rolling.text_column(batch, "text")
            doc, h, base = (rolling.column(batch, c) for c in ("doc", "h", "base"))
            for held in rolling.pieces(offsets, length, block):
                place = np.array(held)
                size = place[:, 3] - place[:, 2] - length + 1
                which = np.repeat(np.arange(len(place)), size)
                inside = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                row, at = place[which, 0], place[which, 2] + inside
                lo = base[row] + place[which, 1] + inside
                first = int(place[0, 2])
                sums = rolling.prefix(rolling.byte_values(data[first : int(place[-1, 3])]))
                key = rolling.slices(sums, at - first, at - first + length)
                order = np.lexsort((lo, h[row], doc[row], key))
                key, row, lo, at = key[order], row[order], lo[order], at[order]
                head = np.ones(len(key), bool)
                head[1:] = key[1:] != key[:-1]
                mine = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
                twin = (doc[row] == doc[row][mine]) & (h[row] == h[row][mine]) & (lo == lo[mine])
                keep = head | ~twin
                key, row, lo, at, head = key[keep], row[keep], lo[keep], at[keep], head[keep]
                suffix = [data[a : a + length].tobytes() if x else None for a, x in zip(at, head, strict=True)]
                spread = rolling.mix(key + lo.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(head, key, spread).view(np.int64)),
                        pa.array(suffix, pa.binary()),
                        pa.array(doc[row]),
                        pa.array(h[row]),
                        pa.array(lo.astype(np.int32)),
                        pa.array(np.where(head, GLOBAL, SURE).astype(np.int32)),
                    ],
                    ["key", "suffix", "doc", "h", "lo", "kind"],
                )

    return run


def _factors(suffixes: DataFrame) -> DataFrame:
    """Suffixes with a previous factor: the left neighbour in suffix order has the same first bytes and another place."""
    order = Window.partitionBy("key").orderBy("suffix", "doc", "h", "lo")
    left, place = F.lag(F.struct("suffix", "doc", "h", "lo")).over(order), F.struct("suffix", "doc", "h", "lo")
    run = Window.partitionBy("key", "suffix").orderBy("doc", "h", "lo").rowsBetween(Window.unboundedPreceding, 0)
    found = (F.col("kind") == SURE) | ((F.col("left.suffix") == F.col("suffix")) & (F.col("earliest") != F.struct("doc", "h", "lo")))
    return (
        suffixes.withColumn("left", left)
        .withColumn("earliest", F.first(F.struct("doc", "h", "lo")).over(run))
        .where(found)
        .select("doc", "h", "lo", F.lit(1).alias("n"))
    )


def repeated_ranges(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc, h, lo, n: starts of all byte strings of min_bytes that also start earlier."""
    texts = repeats.keyed(docs)
    found = []
    for share in GRAMS:
        k = min(max(int(min_bytes * share), 1), min_bytes)
        settled = _settled(texts.mapInArrow(repeats.span_records(min_bytes, k), repeats.SCHEMA))
        found.append(settled.where(F.col("kind") == SURE).select("doc", "h", "lo", "n"))
        open_ranges = repeats.packed_ranges(settled.where(F.col("kind") == OPEN), "base")
        texts = stash(texts.join(open_ranges, ["doc", "h", "base"]).mapInArrow(_cut(min_bytes), CUT))
    found.append(stash(_factors(texts.mapInArrow(_suffixes(min_bytes), SUFFIX))))
    return found[0].unionAll(found[1]).unionAll(found[2])


def kept_bytes(text: Column, spots: Column, min_bytes: int, as_text: bool = False) -> Column:
    """Struct n_bytes, n_removed, n_spans, kept of a text and its ranges; kept as bytes, or as text of its whole characters."""
    kind = "string" if as_text else "binary"

    @F.arrow_udf(f"struct<{KEPT}:{kind}>")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        data, offsets = rolling.binary(texts)
        values, at = repeats.lists(ranges)
        size, removed, runs, kept = np.diff(offsets), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), []
        for i in range(len(texts)):
            own = data[offsets[i] : offsets[i + 1]]
            if at[i] == at[i + 1]:
                kept.append(own.tobytes())
                continue
            gone = repeats.covered(values[at[i] : at[i + 1]], min_bytes, len(own))
            removed[i] = gone.sum()
            runs[i] = gone[0] + (gone[1:] & ~gone[:-1]).sum()
            kept.append(own[~gone].tobytes())
        last = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        return pa.StructArray.from_arrays([pa.array(size), pa.array(removed), pa.array(runs), last], ["n_bytes", "n_removed", "n_spans", "kept"])

    return cut(text, spots)


def suffix_dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, as_text: bool = False) -> DataFrame:
    """row (all columns of docs), n_bytes, n_removed, n_spans and kept, the bytes (or text) that stay."""
    joined = repeats.with_ranges(docs, repeated_ranges(docs, min_bytes))
    return joined.select("row", kept_bytes(F.col("text"), F.col("spots"), min_bytes, as_text).alias("out")).select("row", "out.*")


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """docs with the texts that stay, and n_chars, if there is one, to match.

    Cuts can fall inside a character; what is left of it goes, too.
    """
    out = suffix_dedup(docs, min_bytes, as_text=True)
    texts = out.select("row", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")).alias("text"))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.coalesce(F.length("text"), F.col("row.n_chars"))
    kinds = dict(docs.dtypes)
    return texts.select(*(fresh.get(c, F.col("row").getField(c)).cast(kinds[c]).alias(c) for c in docs.columns))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
