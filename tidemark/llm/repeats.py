"""Span records of a table of documents, shared by the two operators on long repeats.

A document is the pair (doc, h) of its id (null: the smallest long, so first in order) and a 64-bit hash of its
text; rows with the same id and text are one document and get the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling

NULL_ID = -(1 << 63)
GLOBAL, SURE = 0, 1
SCHEMA = "anchor long, content long, doc long, h long, base int, lo int, n int, copies int, kind int"
COLUMNS = SCHEMA.replace("long", "").replace("int", "").replace(",", "").split()


def keyed(docs: DataFrame) -> DataFrame:
    """doc, h, base, text (null: empty) of a table with doc_id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("h"), F.lit(0).alias("base"), text.alias("text"))


def combined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Equal spans of one block become one global record, the first, with their number; the others are sure repeats."""
    order = np.lexsort((rows["lo"], rows["h"], rows["doc"], rows["content"], rows["anchor"]))
    rows = {name: values[order] for name, values in rows.items()}

    def differs(*names: str) -> np.ndarray:
        out = np.ones(len(order), bool)
        if len(order):
            out[1:] = np.logical_or.reduce([rows[x][1:] != rows[x][:-1] for x in names])
        return out

    kept = differs("anchor", "content", "doc", "h", "lo")
    rows = {name: values[kept] for name, values in rows.items()}
    order = order[kept]
    head = differs("anchor", "content")
    at = np.flatnonzero(head)
    copies = np.diff(np.append(at, len(head)))
    rows["copies"] = np.repeat(copies, copies).astype(np.int32)
    rows["kind"] = np.where(head, GLOBAL, SURE).astype(np.int32)
    spread = rolling.mix(rows["anchor"] + rows["lo"].astype(np.uint64) + rows["doc"].astype(np.uint64))
    rows["anchor"] = np.where(head, rows["anchor"], spread)
    rows["content"] = np.where(head, rows["content"], np.uint64(0))
    return rows


def as_batch(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows["anchor"].view(np.int64)),
            pa.array(rows["content"].view(np.int64)),
            pa.array(rows["doc"].astype(np.int64)),
            pa.array(rows["h"].astype(np.int64)),
            *(pa.array(rows[c].astype(np.int32)) for c in ("base", "lo", "n", "copies", "kind")),
        ],
        COLUMNS,
    )


def span_records(length: int, k: int, words: bool = False) -> Callable:
    """mapInArrow function: (doc, h, base, text) to span records; base is the place of the text's first unit in its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = rolling.text_column(batch, "text")
            doc, h, base = (rolling.column(batch, c) for c in ("doc", "h", "base"))
            if words:
                starts, ends, offsets = rolling.words_of(data, offsets)
                units = rolling.word_hashes(data, starts, ends)
            # eight bytes a word, so a block of words takes the room of a block of bytes
            for block in rolling.pieces(offsets, length, rolling.BLOCK_BYTES >> (3 if words else 0)):
                place = np.array(block)
                parts = [units[a:b] if words else rolling.byte_values(data[a:b]) for _, _, a, b in block]
                bounds = np.concatenate(([0], np.cumsum(place[:, 3] - place[:, 2])))
                found = rolling.spans(np.concatenate(parts), bounds, length, k)
                piece = found.pop("piece")
                row = place[piece, 0]
                lo = found["lo"] - bounds[piece] + place[piece, 1] + base[row]
                yield as_batch(combined(found | {"doc": doc[row], "h": h[row], "base": base[row], "lo": lo}))

    return run


def packed_ranges(flagged: DataFrame, *more: str) -> DataFrame:
    """doc, h, more, spots: all (lo << 32 | n) of a document, each once."""
    spot = F.shiftleft(F.col("lo").cast("long"), 32).bitwiseOR(F.col("n").cast("long"))
    return flagged.groupBy("doc", "h", *more).agg(F.collect_set(spot).alias("spots"))


def with_ranges(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """row (the columns of docs as they are), text, spots; spots is null where nothing is flagged."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    rows = docs.select(F.struct("*").alias("row"), doc.alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows.join(packed_ranges(flagged), ["doc", "h"], "left").select("row", "text", "spots")


def covered(spots: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of size units lie in a window that starts in one of the ranges."""
    change = np.zeros(size + 1, np.int32)
    lo = spots >> 32
    np.add.at(change, lo, 1)
    np.add.at(change, lo + (spots & 0xFFFFFFFF) - 1 + length, -1)
    return np.cumsum(change[:size]) > 0


def lists(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and n + 1 offsets of a list column; null is an empty list."""
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    return values.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
