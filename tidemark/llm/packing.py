"""Packing of token ids into sequences, by best-fit decreasing.

Documents longer than a sequence are cut into full windows first. The rests and the short documents go,
longest first, each into the open sequence with the least room that still holds it; a segment tree over the
remaining capacities finds it in logarithmic time. Sequences that end up with more than ``slack`` free places
are taken apart and laid end to end, cut at the sequence length; what remains behind the last full one is cut
into sequences whose lengths are powers of two, which need no padding.

Work is done in blocks of some million ids inside each task, so there is no shuffle, memory is bounded by a
block (or by one document, if it is longer), and the padding stays under ``slack`` places a sequence however
the input is split.

Null text is empty: such a document is its end id alone. Every row is a document of its own, also rows that
repeat an id; a null doc_id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.shared import table
from tidemark.llm.tokens import encoder

SEQUENCE = 2048
SLACK = 8
END_ID = 1
BLOCK_BYTES = 2 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Capacities:
    """Open bins by remaining capacity: a segment tree that counts them, over stacks of bins."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Room and bin of the fullest bin that has room for need; the bin is taken out."""
        count, node = self.count, need + self.size
        while not count[node]:
            while node & 1:  # a right child: go up until there is a right neighbour
                node >>= 1
            if not node:
                return None
            node += 1
            if not node & (node - 1):  # ran off the right edge of its level
                return None
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[list[list[int]], list[int]]:
    """Bins of item numbers and their free room; items are at most capacity long."""
    open_bins, bins, free = Capacities(capacity), [], []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        found = open_bins.tightest(need)
        if found is None:
            bins.append([])
            free.append(capacity)
            found = capacity, len(bins) - 1
        room, which = found
        bins[which].append(item)
        free[which] = room - need
        if room > need:
            open_bins.put(room - need, which)
    return bins, free


def plan(sizes: np.ndarray, capacity: int, slack: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) for documents of the given numbers of ids."""
    out: list[list[tuple[int, int, int]]] = []
    for doc in np.flatnonzero(sizes >= capacity).tolist():
        out += [[(doc, at, capacity)] for at in range(0, int(sizes[doc]) // capacity * capacity, capacity)]
    rest = sizes % capacity
    docs = np.flatnonzero(rest)
    bins, free = best_fit(rest[docs], capacity)
    loose: list[tuple[int, int, int]] = []
    for items, room in zip(bins, free, strict=True):
        pieces = [(int(d), int(sizes[d] - rest[d]), int(rest[d])) for d in docs[items]]
        if room > slack:
            loose += pieces
        else:
            out.append(pieces)
    left = sum(n for _, _, n in loose)
    now: list[tuple[int, int, int]] = []
    target = room = min(capacity, 1 << left.bit_length() - 1) if left else 0
    for doc, start, n in loose:
        while n:
            take = min(n, room)
            now.append((doc, start, take))
            start, n, room, left = start + take, n - take, room - take, left - take
            if not room:
                out.append(now)
                now = []
                target = min(capacity, 1 << left.bit_length() - 1) if left else 0
                room = target
    return out


def _slabs(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most so many bytes of text, a longer text alone."""
    _, offsets = rolling.text_column(batch, "text")
    at = 0
    while at < batch.num_rows:
        to = max(int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1, at + 1)
        yield batch.slice(at, to - at)
        at = to


def packer(path: str, end_id: int, capacity: int, slack: int, lower: bool, with_ids: bool) -> Callable:
    """mapInArrow function: (doc_id, text) rows to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 40
        ids_of = encoder(path, lower)
        held, room = [], BLOCK_BYTES
        names = PIECES.replace(" long", "").split(", ")

        def emit(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal serial
            block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            ids, offsets = ids_of.encode(block.column("text"), end_id)
            sizes = np.diff(offsets)
            sequences = plan(sizes, capacity, slack)
            flat = np.array([(d, s, n, i) for i, pieces in enumerate(sequences) for d, s, n in pieces], np.int64).reshape(-1, 4)
            doc, start, n, sequence = flat.T
            before = np.cumsum(n) - n
            head = np.ones(len(n), bool)
            head[1:] = sequence[1:] != sequence[:-1]
            offset = before - np.maximum.accumulate(np.where(head, before, 0))
            begin = offsets[doc] + start
            raw = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(raw[a : a + b]) for a, b in zip(begin, n, strict=True)]
            doc_id = block.column("doc_id").take(pa.array(doc))
            columns = [doc_id, *map(pa.array, (start, n, np.array(crc, np.int64), sizes[doc], serial + sequence, offset))]
            if with_ids:
                columns.append(pa.array([raw[a : a + b].astype(np.int32) for a, b in zip(begin, n, strict=True)], pa.list_(pa.int32())))
            serial += len(sequences)
            out = pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)
            for i in range(0, out.num_rows, 4096):
                yield out.slice(i, 4096)

        for batch in batches:
            for slab in _slabs(batch, BLOCK_BYTES):
                size = int(np.diff(rolling.text_column(slab, "text")[1][[0, -1]])[0])
                if held and size > room:
                    yield from emit(held)
                    held, room = [], BLOCK_BYTES
                held.append(slab)
                room -= size
        if held:
            yield from emit(held)
        pa.default_memory_pool().release_unused()

    return run


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = END_ID,
    capacity: int = SEQUENCE,
    slack: int = SLACK,
    lower: bool = True,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents with their place in sequences, and their ids unless told otherwise."""
    schema = PIECES + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packer(path, end_id, capacity, slack, lower, with_ids), schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
