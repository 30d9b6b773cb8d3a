"""Text quality: logistic regression over hashed word n-grams.

Words are the runs between white space; each stands as itself and as its shape (case, digits, what it ends with,
whether it repeats the word before). One- and two-grams of the words and one- to three-grams of the shapes are
hashed into slots. A text's feature values are the shares of its n-grams, so a score is a sparse dot product that
needs no sorting: the mean of the weights of all n-grams.

Null and empty texts have no n-grams and get the score of the bias alone. Rows that repeat an id are scored each on
their own. Only text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ftrl, rolling
from tidemark.llm.shared import table

FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
SCALE = 30.0
HOW = ftrl.Settings(alpha=0.5, l1=0.0, l2=0.01, epochs=4, rows=8000)
_KINDS = 5
_SHIFT = np.uint64(64 - ftrl.SLOTS_LOG2)


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_UPPER, _LOWER, _DIGIT = _flags((65, 90)), _flags((97, 122)), _flags((48, 57))
_ALNUM = _flags((48, 57), (65, 90), (97, 122), (128, 255))


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    base = starts[0]
    own = data[base : ends[-1]]

    def count(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flag[own], dtype=np.int32)))
        return sums[ends - base] - sums[starts - base]

    size = ends - starts
    upper, lower, digit, alnum = count(_UPPER), count(_LOWER), count(_DIGIT), count(_ALNUM)
    last = data[ends - 1].astype(np.uint64)
    before = np.where(size > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    tail = np.where(alnum == size, np.uint64(0), (last << np.uint64(8)) | np.where(_ALNUM[before.astype(np.uint8)], np.uint64(0), before))
    same = np.zeros(len(size), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same &= ~first
    code = np.uint64(1) * (upper > 1) + np.uint64(2) * (lower > 0) + np.uint64(4) * (digit > 0) + np.uint64(8) * same
    code = code.astype(np.uint64) + np.uint64(16) * (np.minimum(size, 40) // 8).astype(np.uint64) + np.uint64(128) * (alnum == 0)
    return rolling.mix(code.astype(np.uint64) + (tail << np.uint64(16)) + np.uint64(77))


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram the row and slot of all of them."""
    starts, ends, words = rolling.words_of(data, offsets)
    if not len(starts):
        return
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words))
    first = np.zeros(len(row) + 1, bool)
    first[words] = True
    first = first[:-1]
    word = rolling.word_hashes(data, starts, ends)
    shape = _shapes(data, starts, ends, word, first)
    kind = 0
    for units, most in ((word, 2), (shape, 3)):
        gram = units
        for n in range(1, most + 1):
            kind += 1
            if n > 1:
                gram = rolling.mix(gram[:-1] * np.uint64(3) + units[n - 1 :])
            inside = row[: len(gram)] == row[n - 1 :]
            yield row[: len(gram)][inside], rolling.mix(gram[inside] + np.uint64(kind)) >> _SHIFT


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, slots, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for row, slot in grams(data, offsets):
        total = np.bincount(row, minlength=len(offsets) - 1)
        rows.append(row)
        slots.append(slot.astype(np.int64))
        values.append(SCALE / total[row])
    key = (np.concatenate(rows) << ftrl.SLOTS_LOG2) | np.concatenate(slots)
    key, which = np.unique(key, return_inverse=True)
    return key >> ftrl.SLOTS_LOG2, key & ((1 << ftrl.SLOTS_LOG2) - 1), np.bincount(which, np.concatenate(values), len(key))


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    total = np.full(len(offsets) - 1, bias)
    for row, slot in grams(data, offsets):
        count = np.bincount(row, minlength=len(total))
        total += SCALE * np.bincount(row, weights[slot], len(total)) / np.maximum(count, 1)
    return ftrl.sigmoid(total)


def score_texts(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """row (the columns of docs as they are) and score."""

    def score(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 256):
            out.append(scores(*rolling.binary(texts[at : at + 256]), weights, bias))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.select(F.struct("*").alias("row"), F.arrow_udf(score, "double")(F.col("text").cast("string")).alias("score"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = ftrl.is_held_out(FOLDS, FOLD)
    weights, bias = ftrl.learnt(docs, table(spark, sf_dir, "labels"), "quality", held_out, features, HOW)
    found = score_texts(docs, weights, bias).select("row.doc_id", "score")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
