"""Word splitting and hashing over Arrow text columns, in numpy.

All positions are byte positions in UTF-8.  Both word definitions used here
are ASCII classes under which every byte of a multi-byte character is a word
byte, so splitting bytes gives the same words as splitting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about this many bytes (a longer text alone).
SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for bytes of a word ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[0x20] = False
NON_SPACE[0x09:0x0E] = False

#: True for bytes of a word ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, after lower-casing A-Z.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        p, q = np.full(size, _BASE, dtype=np.uint64), np.full(size, _BASE_INV, dtype=np.uint64)
        p[0] = q[0] = 1
        if size > 4 * SLICE_BYTES:  # a very long text: do not keep its tables
            return np.multiply.accumulate(p), np.multiply.accumulate(q)
        _powers, _inverse = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """Words of a slice of texts: ``first[d]:first[d + 1]`` are those of text d."""

    data: np.ndarray    # lower-cased bytes
    bounds: np.ndarray  # byte offsets of the texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        p, q = _power_tables(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[self.data] * p[:len(self.data)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * q[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def spelled(words: Words, which: np.ndarray) -> pa.Array:
    """These words as an Arrow array."""
    starts, sizes = words.starts[which], words.ends[which] - words.starts[which]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(words.data[at]))


def whole_hashes(column: pa.Array) -> np.ndarray:
    """The hash that :meth:`Words.hashes` gives each text as one word (lower-cased already)."""
    out = [np.empty(0, dtype=np.uint64)]
    for i, j, data, bounds in text_slices(column):
        out.append(Words(data, bounds, bounds[:-1], bounds[1:], np.arange(j - i + 1)).hashes())
    return np.concatenate(out)


def hash_word(word: str) -> int:
    """The hash that :meth:`Words.hashes` gives this word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    w = Words(raw, np.array([0, len(raw)]), np.array([0]), np.array([len(raw)]), np.array([0, 1]))
    return int(w.hashes()[0])


def split_words(data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray) -> Words:
    data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = word_bytes[data]
    left, right = inside[:-2].copy(), inside[2:].copy()
    cuts = bounds[(bounds > 0) & (bounds < len(data))]  # a word ends with its text
    left[cuts] = False
    right[cuts - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~left)
    ends = np.flatnonzero(inside[1:-1] & ~right) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from row, to row, bytes, byte offsets of the rows)`` of a text column; a null is empty."""
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.empty(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_STEPS = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: the sorted distinct k-word shingles of each text.

    A text of fewer than k words, but not none, has its whole word sequence as
    its only shingle.
    """
    h = words.hashes()
    counts, n = words.counts(), len(h)
    text = words.text_of()
    if n >= k:
        last = n - k + 1
        acc = np.full(last, k, dtype=np.uint64)
        for j in range(k):
            acc += h[j:j + last] * _STEPS[j]
        ok = text[:last] == text[k - 1:]
        out, of = mix(acc[ok]), text[:last][ok]
    else:
        out, of = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for x, d in enumerate(short):
            w = h[words.first[d]:words.first[d + 1]]
            extra[x:x + 1] = (w * _STEPS[:len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(w))
        out, of = np.concatenate([out, mix(extra)]), np.concatenate([of, short])
    order = np.lexsort((out, of))
    out, of = out[order], of[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (of[1:] != of[:-1])
    out, of = out[new], of[new]
    return out, np.searchsorted(of, np.arange(len(counts) + 1))


