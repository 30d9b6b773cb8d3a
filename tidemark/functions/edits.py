"""Edit distances of one block of names against another, many at a time.

Neighbouring cells of the table of two names differ by -1, 0 or 1, and along a diagonal by 0 or 1 (Ukkonen, "Algorithms
for approximate string matching", Information and Control 1985). So a cell is a few truth values. Here a machine word
holds one such value for 64 names of a block, and numpy takes a cell on for all of them, and for many names of the other
block, at once. Only the diagonals that a path of ``k`` edits can reach are gone through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Longest name that is compared so.
LONGEST = 64
#: Pairs in one batch of results.
PAIRS = 100_000
#: Words that one step takes on, and bytes of the marks of a part of a block.
WORDS, MARKS = 8192, 1 << 25

WORD = np.dtype("<u8")
ALL = WORD.type(2**64 - 1)


def _codes(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each name, a row a name, and the lengths; cells behind a name hold zero."""
    sizes = np.fromiter(map(len, names), np.int64, len(names))
    wide = int(sizes.max(initial=0))
    points = np.zeros((len(names), wide), np.uint32)
    points[np.arange(wide) < sizes[:, None]] = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, sizes


def _marks(theirs: np.ndarray, letters: int) -> np.ndarray:
    """For each place and letter the names that hold it there, a bit a name."""
    n, wide = theirs.shape[1], -(-len(theirs) // 64)
    out = np.empty((n, letters, wide), WORD)
    held = np.zeros((letters, wide * 64), bool)
    for j in range(n):
        held[:] = False
        held[theirs[:, j], np.arange(len(theirs))] = True
        out[j] = np.packbits(held, axis=1, bitorder="little").view(WORD)
    return out


def _near(mine: np.ndarray, marks: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``mine``, bits of ``marks`` and distances of the pairs within ``k`` edits, for names of two lengths."""
    (rows, m), (n, _, wide) = mine.shape, marks.shape
    gap = n - m
    spare = k - abs(gap)  # edits besides those that the lengths ask for, half of them to each side
    low, high = min(gap, 0) - spare // 2, max(gap, 0) + spare // 2
    shape = (rows, wide)
    # steps to the right and down that go up (plus) or down (minus) by one; at the edges all go up
    plus, minus = np.empty((n + 1, *shape), WORD), np.empty((n + 1, *shape), WORD)
    up, down, same, one, more, less = np.empty((6, *shape), WORD)
    plus, minus, reached = list(plus), list(minus), 0
    # counts what exceeds the spare edits by running over
    places = int(spare).bit_length()
    start = (1 << places) - 1 - spare
    count = [np.full(shape, ALL if start >> b & 1 else 0, WORD) for b in range(places)]
    over = np.zeros(shape, WORD)
    for i in range(1, m + 1):
        first, last = max(1, i + low), min(n, i + high)
        letters, edge = mine[:, i - 1], True
        for j in range(first, last + 1):
            np.take(marks[j - 1], letters, axis=0, out=same, mode="clip")
            top = j > reached
            # same: no step along the diagonal
            if not edge:
                same |= down
            if not top:
                same |= minus[j]
            if j == i + gap:
                np.invert(same, out=one)
                for c in count:
                    np.bitwise_and(c, one, out=more)
                    c ^= one
                    one, more = more, one
                over |= one
            if i < m and j >= i + 1 + low:
                if edge:
                    more[:] = 0
                    less[:] = same
                else:
                    np.bitwise_or(same, up, out=more)
                    np.invert(more, out=more)
                    more |= down
                    np.bitwise_and(same, up, out=less)
            if j < last:
                if top:
                    up[:] = 0
                    down[:] = same
                else:
                    np.bitwise_or(same, plus[j], out=up)
                    np.invert(up, out=up)
                    up |= minus[j]
                    np.bitwise_and(same, plus[j], out=down)
            if i < m and j >= i + 1 + low:
                plus[j], minus[j], more, less = more, less, plus[j], minus[j]
            edge, reached = False, max(reached, j)
    np.invert(over, out=over)
    over &= valid
    words = np.flatnonzero(over)
    at, bit = np.nonzero(np.unpackbits(over.ravel()[words].view(np.uint8), bitorder="little").reshape(-1, 64))
    at = words[at]
    edits = np.full(len(at), abs(gap) - start, np.int64)
    for b, c in enumerate(count):
        edits += (c.ravel()[at] >> bit.astype(WORD) & WORD.type(1)).astype(np.int64) << b
    row, word = np.divmod(at, wide)
    return row, word * 64 + bit, edits


def near_pairs(left: list[str], right: list[str], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``left``, places in ``right`` and distances of the pairs within ``k`` edits, some at a time."""
    (mine, my_sizes), (theirs, sizes) = _codes(left), _codes(right)
    for n in np.unique(sizes):
        of_length = np.flatnonzero(sizes == n)
        letters, at = np.unique(theirs[of_length, :n], return_inverse=True)
        at = at.reshape(len(of_length), n)
        # a letter that none of them holds has a row of its own, without marks
        spot = np.searchsorted(letters, mine)
        known = spot < len(letters)
        known[known] = letters[spot[known]] == mine[known]
        spot[~known] = len(letters)
        part = max(64, MARKS // max(1, n * (len(letters) + 1) * 8) * 64)
        for begin in range(0, len(of_length), part):
            names = of_length[begin : begin + part]
            marks = _marks(at[begin : begin + part], len(letters) + 1)
            wide = marks.shape[2]
            valid = np.packbits(np.arange(wide * 64) < len(names), bitorder="little").view(WORD)
            step = max(1, WORDS // wide)
            for m in range(max(0, n - k), n + k + 1):
                own = np.flatnonzero(my_sizes == m)
                for b in range(0, len(own), step):
                    batch = own[b : b + step]
                    row, bit, edits = _near(spot[batch, :m], marks, valid, k)
                    if len(row):
                        yield batch[row], names[bit], edits


def compared(k: int):
    """mapInArrow function: rows of two blocks of names, mine and theirs, to the pairs (a, b, distance) within ``k`` edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, theirs in zip(batch.column("mine"), batch.column("theirs"), strict=True):
                a, b = mine.values, theirs.values
                kept, size = [], 0

                def packed(kept=kept, a=a, b=b) -> pa.RecordBatch:
                    rows, cols, edits = (np.concatenate(x) for x in zip(*kept, strict=True))
                    return pa.RecordBatch.from_arrays(
                        [a.take(pa.array(rows)), b.take(pa.array(cols)), pa.array(edits.astype(np.int32))], ["a", "b", "distance"]
                    )

                for hit in near_pairs(a.to_pylist(), b.to_pylist(), k):
                    kept.append(hit)
                    size += len(hit[0])
                    if size >= PAIRS:
                        yield packed()
                        kept.clear()
                        size = 0
                if kept:
                    yield packed()

    return run
