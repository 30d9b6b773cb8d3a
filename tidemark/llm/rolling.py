"""Rolling hashes over blocks of text and the grouping of windows by their smallest k-gram.

A window is ``length`` consecutive units (bytes or words) of one document. Every window is keyed by the
smallest hash among its k-grams. Neighbouring windows mostly share that k-gram, so they form one *span*:
(anchor hash, span hash, first window, number of windows). Equal windows always have equal anchors, and
spans with equal content hold equal windows, so the corpus is compared span by span (a few per cent of
the positions) and single windows only where one anchor has spans of different content.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20
LONG_WORD = 256
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of powers don't show in the hash order."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                values = np.full(max(n, 1 << 16), base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


_powers = Powers()


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64, one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers.upto(len(values))[0], out=out[1:])
    return out


def slices(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of [start, end) slices, whatever their place."""
    down = _powers.upto(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and its n + 1 offsets; null is empty."""
    return binary(batch.column(batch.schema.get_field_index(name)))


def binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every row: starts, ends and the n + 1 word offsets of the rows."""
    first, last = int(offsets[0]), int(offsets[-1])
    space = np.ones(last - first + 1, bool)
    space[:-1] = _SPACE[data[first:last]]
    begins = np.zeros(last - first + 1, bool)
    begins[offsets - first] = True
    after = np.ones(len(space), bool)
    after[1:] = space[:-1]
    starts = np.flatnonzero(~space & (after | begins))
    ends = np.flatnonzero((space | begins) & ~after)
    return starts + first, ends + first, np.searchsorted(starts + first, offsets)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = BLOCK_BYTES) -> np.ndarray:
    """A hash of every word; long words have one that isn't linear, as polynomials fail on some sequences of 1 024 letters."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + block, side="right")), at + 1)
        base = starts[at]
        out[at:to] = slices(prefix(byte_values(data[base : ends[to - 1]])), starts[at:to] - base, ends[at:to] - base)
        at = to
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=1)
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by minima from both ends of blocks of w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def spans(values: np.ndarray, bounds: np.ndarray, length: int, k: int) -> dict[str, np.ndarray]:
    """The spans of a block: values are unit hashes, bounds the n + 1 offsets of its pieces.

    Returns arrays piece, lo (in the block), n (windows), anchor, content.
    """
    sums = prefix(values)
    down = _powers.upto(len(sums))[1]
    n_grams = max(len(values) - k + 1, 0)
    grams = mix((sums[k : k + n_grams] - sums[:n_grams]) * down[:n_grams])
    low = sliding_min(grams, length - k + 1)
    if not len(low):
        empty = np.zeros(0, np.int64)
        return {"piece": empty, "lo": empty, "n": empty, "anchor": empty.astype(np.uint64), "content": empty.astype(np.uint64)}
    valid = np.zeros(len(values) + 1, np.int8)
    last = np.maximum(bounds[1:] - length + 1, bounds[:-1])
    np.add.at(valid, bounds[:-1], 1)
    np.add.at(valid, last, -1)
    valid = np.cumsum(valid[: len(low)]) > 0
    new = np.ones(len(low), bool)
    # a window that starts with its smallest k-gram is the last one for that place of it, so equal windows of
    # one document never share a span
    new[1:] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1]) | (grams[: len(low) - 1] == low[:-1])
    lo = np.flatnonzero(new)
    n = np.diff(np.append(lo, len(low)))
    keep = valid[lo]
    lo, n = lo[keep], n[keep]
    return {
        "piece": np.searchsorted(bounds, lo, side="right") - 1,
        "lo": lo,
        "n": n,
        "anchor": low[lo],
        "content": slices(sums, lo, lo + n - 1 + length),
    }


def pieces(offsets: np.ndarray, length: int, block: int = BLOCK_BYTES) -> list[list[tuple[int, int, int, int]]]:
    """Blocks of (row, first window, start, end): whole rows while they fit, long rows cut with an overlap of length - 1."""
    out, now, held = [], [], 0
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        if end - begin < length:
            continue
        at = begin
        while at + length <= end:
            stop = min(end, at + block + length - 1)
            if held and held + stop - at > block:
                out.append(now)
                now, held = [], 0
            now.append((row, at - begin, at, stop))
            held += stop - at
            at = stop - length + 1
    if now:
        out.append(now)
    return out
