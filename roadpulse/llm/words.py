"""Words of many texts at once, as arrays of 64-bit hashes.

Works on the bytes of a whole Arrow column. A word is a run of bytes other than
ASCII white space, which UTF-8 never uses inside a character.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@dataclass
class Words:
    """Words of some texts, one text after another.

    ``hashes`` of all words; text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``.
    ``starts`` and ``ends`` are byte places in ``data``.
    """

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.bounds[i], self.bounds[i + 1])

    def text_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by a line feed, and where each text starts; null is empty."""
    values = [b"" if v is None else v for v in texts.cast(pa.binary()).to_pylist()]
    starts = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) + 1 for v in values], out=starts[1:])
    return np.frombuffer(b"\n".join([*values, b""]), np.uint8), starts


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; with ``lower``, A-Z count as a-z."""
    data, text_starts = joined_bytes(texts)
    inside = ~_SPACE[data]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    bounds = np.searchsorted(starts, text_starts)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), bounds, starts, ends, data)
    lengths = ends - starts
    # The bytes of words alone, each weighted by its place in its word.
    kept = data[inside]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(kept)) - np.repeat(first, lengths)
    value = _BYTE[(_LOWER if lower else _SAME)[kept]] * powers(_BASE, int(lengths.max()))[place]
    return Words(mix(np.add.reduceat(value, first)), bounds, starts, ends, data)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, of one text or of texts in a row."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for weight, k in zip(powers(_STEP, n), range(n), strict=True):
        out += hashes[k : k + len(out)] * weight
    return mix(out)


def sequence(hashes: np.ndarray) -> np.uint64:
    """A hash of a whole sequence; its length counts."""
    total = (hashes * powers(_STEP, len(hashes))).sum(dtype=np.uint64, keepdims=True)
    return mix(total + np.array([len(hashes)], np.uint64) * _BASE)[0]


def gram_bounds(bounds: np.ndarray, n: int) -> np.ndarray:
    """How many runs of ``n`` words each text has."""
    return np.maximum(np.diff(bounds) - n + 1, 0)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``n`` words, lower case.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    found = words(texts, lower=True)
    runs = grams(found.hashes, n)
    out = []
    for lo, hi in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True):
        if hi - lo >= n:
            run = np.sort(runs[lo : hi - n + 1])
            out.append(run[np.concatenate(([True], run[1:] != run[:-1]))])
        elif hi > lo:
            out.append(sequence(found.hashes[lo:hi]).reshape(1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
