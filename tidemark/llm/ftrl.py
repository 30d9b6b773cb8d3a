"""Logistic regression over hashed features, trained by following the regularised leader.

The model is fitted on a sample of at most ``rows`` labelled rows, taken in the order of a hash of their id; that
bound is what keeps one task's work and the weights small. Features are computed in parallel, learning itself is a
pass over the sample in one task, and the weights (a fixed number of slots) go to every scoring task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling

SLOTS_LOG2 = 20


@dataclass(frozen=True)
class Settings:
    alpha: float
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    epochs: int = 3
    rows: int = 8000
    #: Parts that are scored by models of the others, to tell where the classes part best; 0 leaves the bias as it is.
    folds: int = 0
    threshold: float = 0.5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(slots: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, how: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias from the sparse rows, in the given order."""
    size = 1 << SLOTS_LOG2
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0, how.l1)
        own = z[at]
        out = -(own - np.sign(own) * l1) / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2)
        return np.where(np.abs(own) <= l1, 0, out)

    one = np.ones(1)
    for _ in range(how.epochs):
        for at, x, y in zip(slots, values, labels, strict=True):
            at, x = np.append(at, size), np.append(x, one)  # the last slot is the bias
            w = weights(at)
            g = (sigmoid(w @ x) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def shift(logits: np.ndarray, labels: np.ndarray, threshold: float) -> float:
    """What to add to the bias so that the best cut between the classes scores as threshold."""
    order = np.argsort(logits, kind="stable")
    logits, labels = logits[order], labels[order]
    # errors of a cut below item i: ones under it and zeros from it on
    errors = np.concatenate(([0], np.cumsum(labels))) + np.concatenate((np.cumsum((1 - labels)[::-1])[::-1], [0]))
    good = np.flatnonzero(errors == errors.min())
    spread = np.concatenate(([logits[0] - 1], logits, [logits[-1] + 1]))
    cuts = (spread[good] + spread[good + 1]) / 2
    return float(np.log(threshold / (1 - threshold)) - np.median(cuts))


def is_held_out(parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) modulo parts is part; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts == part


def learnt(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, features: Callable, how: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias from the labelled rows that aren't held out.

    features: (text bytes, offsets) of a batch to (row, slot, value) arrays, each (row, slot) once. Repeated labels
    of an id count once, as the larger one; ids and labels that are null aren't used.
    """
    known = labels.where(~held_out & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    sample = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                row, slot, value = features(*rolling.text_column(part, "text"))
                at = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.get_field_index(c)) for c in ("doc_id", "y")),
                        pa.ListArray.from_arrays(at, pa.array(slot.astype(np.int32))),
                        pa.ListArray.from_arrays(at, pa.array(value.astype(np.float32))),
                    ],
                    ["doc_id", "y", "slots", "values"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: list[np.ndarray] = []
        values: list[np.ndarray] = []
        ys: list[int] = []
        for batch in batches:
            flat, at = repeats.lists(batch.column(batch.schema.get_field_index("slots")))
            x, _ = repeats.lists(batch.column(batch.schema.get_field_index("values")))
            slots += [flat[a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)]
            values += [x[a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)]
            ys += rolling.column(batch, "y").tolist()
        y = np.array(ys, float)
        weights, bias = train(slots, values, y, how)
        if how.folds and len(set(y)) == 2:
            logits, fold = np.zeros(len(y)), np.arange(len(y)) % how.folds
            for f in range(how.folds):
                rest = np.flatnonzero(fold != f)
                w, b = train([slots[i] for i in rest], [values[i] for i in rest], y[rest], how)
                own = np.flatnonzero(fold == f)
                logits[own] = [w[slots[i]] @ values[i] + b for i in own]
            bias += shift(logits, y, how.threshold)
        used = np.flatnonzero(weights)
        slot = np.append(used, -1)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(np.append(weights[used], bias).astype(np.float64))], ["slot", "weight"])

    ready = rows.mapInArrow(sparse, "doc_id long, y int, slots array<int>, values array<float>")
    fitted = ready.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("y", "slots", "values")
    found = fitted.mapInArrow(fit, "slot int, weight double").toArrow()
    slot, weight = found["slot"].to_numpy(), found["weight"].to_numpy()
    weights = np.zeros(1 << SLOTS_LOG2, np.float32)
    weights[slot[slot >= 0]] = weight[slot >= 0]
    return weights, float(weight[slot < 0].sum())
