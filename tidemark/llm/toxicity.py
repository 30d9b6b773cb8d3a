"""Toxic text: a noisy channel undoes disguised words, then a linear model scores what they say.

Words that look disguised (digits or signs among letters, a letter three times in a row, letters set apart by
spaces or signs) become a lattice: every character may stand for the letters it is used for, a run of one
letter for one or two of it, and signs between letters for nothing. The Viterbi path under a character trigram
model is the restored word. The model counts the letter trigrams of all documents.

A text is scored by the words it holds as written and as restored, each once: hashes of whole words and of their
beginnings, weighed by logistic regression learnt from labelled rows.

Null and empty texts get the score of the bias alone. Rows that repeat an id are scored each on their own. Only
text enters a score.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ftrl, rolling
from tidemark.llm.quality import _flags
from tidemark.llm.shared import table

FOLDS, FOLD = 3, 1
THRESHOLD = 0.7
HOW = ftrl.Settings(alpha=0.3, l1=3.0, l2=0.1, epochs=6, rows=8000, folds=3, threshold=THRESHOLD)
BEGINNINGS = (4, 5)
_SHIFT = np.uint64(64 - ftrl.SLOTS_LOG2)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ASCII = _flags((65, 90), (97, 122))
_LETTER = _flags((65, 90), (97, 122), (128, 255))
_BEFORE_LETTER = np.zeros(256, bool)
_BEFORE_LETTER[list(b"@$!|+(")] = True
_DIGIT = _flags((48, 57))
_INSIDE = np.zeros(256, bool)
_INSIDE[list(b".*_-~'")] = True

#: Characters and the letters they stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
#: Costs in the channel, as negative log probabilities: a substitute, a doubled letter out of a longer run.
SUBSTITUTED, DOUBLED = 1.0, 1.5

# --- character model ---------------------------------------------------------------------------------------

#: Symbols: 0 for what is between words, 1-26 for a-z, 27 for each byte beyond ASCII.
SYMBOLS = 28
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        data, offsets = rolling.text_column(batch, "text")
        for at in range(0, len(offsets) - 1, 256):
            rows = offsets[at : at + 257]
            # two symbols between texts, so that no trigram crosses them
            s = np.insert(_SYMBOL[data[rows[0] : rows[-1]]], np.repeat(rows - rows[0], 2), 0)
            if len(s) > 2:
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["gram", "n"])


def trigram_costs(docs: DataFrame) -> np.ndarray:
    """Negative log probabilities of a symbol after two others, from the counts of all texts.

    At most SYMBOLS**3 counts reach the driver.
    """
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "gram int, n long")
    found = counts.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(SYMBOLS**3)
    table[found["gram"].to_numpy()] = found["n"].to_numpy()
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    single = table.sum(axis=(0, 1)) + 1
    double = table.sum(axis=0) + 1
    p1 = single / single.sum()
    p2 = (double + 5 * p1) / (double.sum(axis=1, keepdims=True) + 5)
    p3 = (table + 5 * p2[None]) / (table.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


# --- channel -----------------------------------------------------------------------------------------------

_RUN = re.compile(r"(.)\1*", re.S)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For every run of one character the strings it may stand for, with their costs."""
    out = []
    for run in _RUN.finditer(word.lower()):
        char, size = run[1], len(run[0])
        if "a" <= char <= "z":
            letters = [(char, 0.0)]
        elif char in LEET:
            letters = [(letter, SUBSTITUTED) for letter in LEET[char]]
        elif char > "\x7f":
            letters = [(char, 0.0)]
        else:
            continue  # a sign that sets letters apart
        options = []
        for letter, cost in letters:
            if size == 1:
                options.append((letter, cost))
            else:
                options += [(letter, cost + (DOUBLED if size > 2 else 0)), (letter * 2, cost + (DOUBLED if size > 2 else 0))]
        out.append(options)
    return out


def _code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27


def restore(word: str, costs: np.ndarray) -> str:
    """The likeliest plain word behind a disguised one."""
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in lattice(word):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for string, price in options:
                x, y, total = a, b, cost + price
                for char in string:
                    z = _code(char)
                    total += costs[x][y][z]
                    x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = total, text + string
        best = after or best
    return min((cost + costs[a][b][0], text) for (a, b), (cost, text) in best.items())[1]


def disguised(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str]]:
    """Row and text of every word that looks disguised, letters set apart by spaces joined."""
    if len(data) < 3:
        return []
    starts, ends, words = rolling.words_of(data, offsets)
    base = int(offsets[0])
    own = data[base : int(offsets[-1])]
    letter = _ASCII[own]
    edge = np.zeros(len(own) + 1, bool)
    edge[offsets - base] = True
    after, before = np.zeros(len(own), bool), np.zeros(len(own), bool)  # a letter of the same text is next to it
    after[:-1] = letter[1:] & ~edge[1:-1]
    before[1:] = letter[:-1] & ~edge[1:-1]
    odd = (_BEFORE_LETTER[own] & after) | (_DIGIT[own] & (after | before)) | (_INSIDE[own] & after & before)
    folded = _FOLD[own]
    odd[2:] |= letter[2:] & before[2:] & before[1:-1] & (folded[2:] == folded[1:-1]) & (folded[1:-1] == folded[:-2])
    out = []
    hit = np.unique(np.searchsorted(starts - base, np.flatnonzero(odd), side="right") - 1)
    row_of = np.searchsorted(words, np.arange(len(starts)), side="right") - 1
    for w in hit.tolist():
        out.append((int(row_of[w]), data[starts[w] : ends[w]].tobytes().decode()))
    # single characters in a row, of the same text
    single = (ends - starts) == 1
    run_start = np.flatnonzero(single & ~np.concatenate(([False], single[:-1] & (row_of[1:] == row_of[:-1]))))
    for w in run_start.tolist():
        to = w
        while to < len(single) and single[to] and row_of[to] == row_of[w]:
            to += 1
        if to - w >= 3:
            text = data[starts[w:to]].tobytes().decode("ascii", "ignore")
            if any(c.isalpha() for c in text):
                out.append((int(row_of[w]), text))
    return out


# --- features ----------------------------------------------------------------------------------------------


def _word_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and slot of every word and beginning; words are runs of letters."""
    first, last = int(offsets[0]), int(offsets[-1])
    own = data[first:last]
    mask = np.zeros(len(own) + 1, bool)
    mask[:-1] = _LETTER[own]
    begins = np.zeros(len(own) + 1, bool)
    begins[offsets - first] = True
    before = np.zeros(len(own) + 1, bool)
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | begins))
    ends = np.flatnonzero(before & (~mask | begins))
    row = np.searchsorted(offsets - first, starts, side="right") - 1
    folded = _FOLD[own]
    rows, slots = [row], [rolling.word_hashes(folded, starts, ends)]
    for size in BEGINNINGS:
        long = ends - starts > size
        rows.append(row[long])
        slots.append(rolling.mix(rolling.word_hashes(folded, starts[long], starts[long] + size) + np.uint64(size)))
    return np.concatenate(rows), (np.concatenate(slots) >> _SHIFT).astype(np.int64)


def slots_of(costs: np.ndarray) -> Callable:
    """Function from (text bytes, offsets) to rows and slots of the words as written and as restored."""
    nested = costs.tolist()  # lists are quicker than arrays for single cells

    memory: dict[str, bytes] = {}

    def plain(word: str) -> bytes:
        if word not in memory:
            if len(memory) > 100_000:
                memory.clear()
            memory[word] = restore(word, nested).encode() + b" "
        return memory[word]

    def run(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, slots = _word_slots(data, offsets)
        found = disguised(data, offsets)
        if found:
            found.sort(key=lambda x: x[0])
            restored = [plain(word) for _, word in found]
            at = np.concatenate(([0], np.cumsum([len(x) for x in restored])))
            more, more_slots = _word_slots(np.frombuffer(b"".join(restored), np.uint8), at)
            rows = np.concatenate((rows, np.array([r for r, _ in found])[more]))
            slots = np.concatenate((slots, more_slots))
        return rows, slots

    return run


def features(costs: np.ndarray) -> Callable:
    slots_in = slots_of(costs)

    def run(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, slots = slots_in(data, offsets)
        key = np.unique((rows << ftrl.SLOTS_LOG2) | slots)
        return key >> ftrl.SLOTS_LOG2, key & ((1 << ftrl.SLOTS_LOG2) - 1), np.ones(len(key))

    return run


def scores(data: np.ndarray, offsets: np.ndarray, slots_in: Callable, weights: np.ndarray, bias: float) -> np.ndarray:
    rows, slots = slots_in(data, offsets)
    used = weights[slots] != 0
    key = np.unique((rows[used] << ftrl.SLOTS_LOG2) | slots[used])
    total = np.bincount(key >> ftrl.SLOTS_LOG2, weights[key & ((1 << ftrl.SLOTS_LOG2) - 1)], len(offsets) - 1)
    return ftrl.sigmoid(total + bias)


def with_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """row (the columns of docs as they are) and toxicity; the model is learnt from the labelled rows that aren't held out."""
    costs = trigram_costs(docs)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights, bias = ftrl.learnt(known, labels, "toxic", ftrl.is_held_out(FOLDS, FOLD), features(costs), HOW)

    def score(texts: pa.Array) -> pa.Array:
        slots_in, out = slots_of(costs), []
        for at in range(0, len(texts), 256):
            out.append(scores(*rolling.binary(texts[at : at + 256]), slots_in, weights, bias))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.select(F.struct("*").alias("row"), F.arrow_udf(score, "double")(F.col("text").cast("string")).alias("toxicity"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_scores(docs, table(spark, sf_dir, "labels")).select("row.doc_id", "toxicity")
    return found.select(
        "doc_id",
        ftrl.is_held_out(FOLDS, FOLD).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
