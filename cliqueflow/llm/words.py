"""Vectorised word splitting and hashing, shared by the text operators.

A word is a run of bytes other than the six ASCII separators (space, tab, line
feed, vertical tab, form feed, carriage return). Nothing here knows about
Spark; the operators call it on one bounded block of texts at a time.
"""

from __future__ import annotations

import numpy as np
import xxhash

SEPARATORS = b"\t\n\x0b\x0c\r "

_SEP = np.zeros(256, dtype=bool)
_SEP[list(SEPARATORS)] = True
#: Every ASCII character but letters and digits, for operators that read plain words.
PUNCTUATED = np.zeros(256, dtype=bool)
PUNCTUATED[[c for c in range(128) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [(1 << 64) - 1], dtype=np.uint64)
_LONG = 64  # bytes; longer words are hashed one by one

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xFF51AFD7ED558CCD)
_D = np.uint64(0xC4CEB9FE1A85EC53)
_33 = np.uint64(33)
_29 = np.uint64(29)


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit hash."""
    h = h ^ (h >> _33)
    h = h * _C
    h = h ^ (h >> _33)
    h = h * _D
    return h ^ (h >> _33)


class Words:
    """The words of a list of texts: byte buffer, word bounds, and the text each word is in."""

    def __init__(self, texts: list[bytes], lower: bool = False, separators: np.ndarray = _SEP):
        raw = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), dtype=np.uint8)
        self.buf = _LOWER[raw] if lower else raw
        size = raw.size - 8
        sep = separators[raw[:size]]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        if not sep[0]:
            edge = np.concatenate(([0], edge))
        self.starts = edge[0::2]
        self.ends = edge[1::2]
        stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        self.n_texts = len(texts)
        self.first = np.concatenate(([0], np.searchsorted(self.starts, stops)))  # words of text i: first[i]..first[i+1]
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return self.starts.size

    def loads(self) -> np.ndarray:
        """View of the buffer as the eight bytes that follow each position."""
        return np.ndarray((self.buf.size - 7,), dtype="<u8", buffer=self.buf, strides=(1,))

    def hashes(self) -> np.ndarray:
        lens = self.ends - self.starts
        h = lens.astype(np.uint64) * _A
        view = self.loads()
        short = lens <= _LONG
        live = np.arange(lens.size) if short.all() else np.flatnonzero(short)
        at = 0
        while live.size:
            x = view[self.starts[live] + at] & _MASK[np.minimum(lens[live] - at, 8)]
            x = x * _B
            x ^= x >> _29
            h[live] = (h[live] ^ x) * _A + _B
            at += 8
            live = live[lens[live] > at]
        for i in np.flatnonzero(~short):
            h[i] = xxhash.xxh64_intdigest(self.buf[self.starts[i] : self.ends[i]].tobytes())
        return mix(h)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a[i]`` and ``b[i]`` are byte for byte the same."""
        return equal_spans(self.loads(), self.starts[a], self.ends[a], self.starts[b], self.ends[b])

    def codes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A number for every word, equal exactly where the words are, and a word of each number."""
        _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        if self.same(np.arange(len(self)), first[code]).all():
            return code, first
        numbers: dict[bytes, int] = {}
        code = np.array([numbers.setdefault(self.word(i), len(numbers)) for i in range(len(self))])
        return code, np.unique(code, return_index=True)[1]

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Kept words each followed by one space, and the byte offset at which each text begins (n_texts + 1)."""
        starts, ends = self.starts, self.ends
        text = self.text
        if keep is not None:
            starts, ends, text = starts[keep], ends[keep], text[keep]
        step = np.zeros(self.buf.size + 1, dtype=np.int8)
        step[starts] = 1
        step[ends + 1] -= 1  # the separator that follows a word is taken as its space
        taken = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        out = self.buf[taken]
        out[_SEP[out]] = 32
        sizes = np.bincount(text, weights=ends - starts + 1, minlength=self.n_texts).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(sizes)))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (k - 1 fewer than words; empty if there are not k)."""
    n = h.size - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= _B
        out += h[j : j + n]
    return mix(out)


def equal_spans(view: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the bytes a..a_end and b..b_end of a buffer (``view``: its eight-byte loads) are equal, pair by pair."""
    size = a_end - a
    out = size == b_end - b
    live = np.flatnonzero(out)
    at = 0
    while live.size:
        mask = _MASK[np.minimum(size[live] - at, 8)]
        differ = ((view[a[live] + at] ^ view[b[live] + at]) & mask) != 0
        out[live[differ]] = False
        at += 8
        live = live[~differ & (size[live] > at)]
    return out
