"""Token ids of whole texts with the tokenizers library, each distinct piece of text encoded once.

Both public vocabularies split a text before they merge anything, so a text may be cut where such a split is
certain, and its ids are those of its parts one after the other. Certain places are those where a run of
spaces and line feeds begins, and between an ASCII letter and a stop or comma. Texts with other white space,
which tokenizers treat in more than one way, are encoded whole, as are texts that hold a string which names a special
token in any case of letters: what becomes of it is left to the library. Pieces are found by 64-bit hashes and then
compared byte by byte.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tidemark.llm import rolling

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space other than space and line feed, by any definition.
_OTHER = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_CACHE = 1_500_000
#: Bytes that are compared at a time.
_COMPARED = 1 << 20


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_GAP = _table(b" \n")
_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_STOP = _table(b".,!?;:")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _unlike(left: np.ndarray, a: np.ndarray, b: np.ndarray, right: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Numbers of the slices left[a:b] that differ from right[c:d], compared some bytes at a time."""
    size = b - a
    differs = size != d - c
    alike = np.flatnonzero(~differs & (size > 0))
    upto = np.concatenate(([0], np.cumsum(size[alike])))
    at = 0
    while at < len(alike):
        to = max(int(np.searchsorted(upto, upto[at] + _COMPARED, side="right")) - 1, at + 1)
        part = alike[at:to]
        within = np.arange(upto[to] - upto[at]) - np.repeat(upto[at:to] - upto[at], size[part])
        same = left[np.repeat(a[part], size[part]) + within] == right[np.repeat(c[part], size[part]) + within]
        if not same.all():
            differs[part] = ~np.logical_and.reduceat(same, upto[at:to] - upto[at])
        at = to
    return np.flatnonzero(differs)


class Encoder:
    """Ids of texts; remembers the ids of pieces up to a bound, then starts anew.

    lower: the vocabulary is lower case, so ASCII texts may be folded before they are cut.
    """

    def __init__(self, path: str, lower: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)", re.IGNORECASE)
        self.lower = lower
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes in order
        self.code = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint16)  # ids stay under 2**16 in both vocabularies
        self.at = np.zeros(1, np.int64)
        self.text = np.zeros(0, np.uint8)  # the pieces themselves
        self.text_at = np.zeros(1, np.int64)

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = [np.zeros(0, np.uint16)], []
        for i in range(0, len(pieces), 64):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[i : i + 64], add_special_tokens=False)]
            lengths += map(len, ids)
            flat.append(np.array(list(chain.from_iterable(ids)), np.uint16))
        return np.concatenate(flat), np.array(lengths, np.int64)

    def _starts(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> np.ndarray:
        gap = _GAP[data]
        new = np.zeros(len(data), bool)
        new[1:] = (gap[1:] & ~gap[:-1]) | (_LETTER[data[:-1]] & _STOP[data[1:]])
        for row in odd:
            new[offsets[row] : offsets[row + 1]] = False
        filled = offsets[:-1][np.diff(offsets) > 0]
        new[filled] = True
        return np.flatnonzero(new)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, with end_id behind every text, and the n + 1 offsets of the texts."""
        data, offsets = rolling.binary(texts)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        odd = [i for i, text in enumerate(texts.to_pylist()) if text is not None and (_OTHER.search(text) or self.special.search(text))]
        if self.lower and len(data):
            wide = np.concatenate(([0], np.cumsum(data > 127)))
            ascii_row = wide[offsets[1:]] == wide[offsets[:-1]]
            ascii_row[odd] = False
            data = np.where(np.repeat(ascii_row, np.diff(offsets)), _LOWER[data], data)
        starts = self._starts(data, offsets, np.array(odd, np.int64))
        ends = np.append(starts[1:], len(data))
        hashes, first, piece = np.unique(rolling.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        # pieces that share a hash with another text are a class of their own
        apart = _unlike(data, starts, ends, data, starts[first[piece]], ends[first[piece]])
        piece[apart] = len(hashes) + np.arange(len(apart))
        stands = np.concatenate((first, apart))
        if len(self.text_at) > _CACHE:
            self._reset()
        place = np.searchsorted(self.known, hashes)
        met = np.zeros(len(hashes), bool)
        inside = place < len(self.known)
        met[inside] = self.known[place[inside]] == hashes[inside]
        code = np.full(len(stands), -1, np.int64)
        code[: len(hashes)][met] = self.code[place[met]]
        at = np.flatnonzero(code >= 0)
        other = _unlike(data, starts[stands[at]], ends[stands[at]], self.text, self.text_at[code[at]], self.text_at[code[at] + 1])
        code[at[other]] = -1
        fresh = np.flatnonzero(code < 0)
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts[stands[fresh]], ends[stands[fresh]], strict=True)]
        ids, lengths = self._ids([p.decode() for p in pieces])
        code[fresh] = len(self.at) - 1 + np.arange(len(fresh))
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(lengths)))
        self.flat = np.concatenate((self.flat, ids))
        self.text_at = np.concatenate((self.text_at, self.text_at[-1] + np.cumsum(np.array(list(map(len, pieces)), np.int64))))
        self.text = np.concatenate((self.text, np.frombuffer(b"".join(pieces), np.uint8)))
        new = np.flatnonzero(~met)
        self.known = np.insert(self.known, place[new], hashes[new])
        self.code = np.insert(self.code, place[new], code[new])
        code = code[piece]
        size = self.at[code + 1] - self.at[code]
        upto = np.concatenate(([0], np.cumsum(size)))
        bounds = upto[np.searchsorted(starts, offsets)] + np.arange(len(offsets))
        out = np.full(bounds[-1], end_id, np.uint32)
        body = np.ones(bounds[-1], bool)
        body[bounds[1:] - 1] = False
        out[body] = self.flat[np.repeat(self.at[code] - upto[:-1], size) + np.arange(upto[-1])]
        return out, bounds


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lower: bool) -> Encoder:
    """The encoder of this process, so that its memory of pieces serves later batches and tasks."""
    key = (path, lower)
    if key not in _encoders:
        _encoders[key] = Encoder(path, lower)
    return _encoders[key]
