"""Word n-grams of many texts, interned in an open-addressed table of NumPy arrays.

Keys are the xxhash64 of an n-gram's bytes. Where a key is already in the table, lengths
and bytes are compared before the n-gram takes its slot, so a collision of keys only
costs a probe. Each slot has its n-gram's bucket (CRC-32 modulo the number of buckets)
and its count; each occurrence has its slot's number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

from roadpulse.llm.words import joined_bytes

LONGEST = 3
# Words per table: with all runs of 1 to 3 words, some 400,000 occurrences.
BLOCK_WORDS = 1 << 17
# Lengths for which appending bytes to a CRC is a lookup.
_SHIFTS = 64

_IN_WORD = np.ones(256, bool)
_IN_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# The primes of xxhash64, from its specification.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)
_STRIPE = 32
_SPACE = np.uint32(zlib.crc32(b" "))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _at(data: np.ndarray, kind: str) -> np.ndarray:
    """The number that starts at each byte; ``data`` has 8 bytes after the last start."""
    return np.ndarray((len(data) - 7,), kind, data, strides=(1,))


def xxhash64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxhash64 of many slices of ``data``, which ends with 8 more bytes.

    Slices are taken by length, so each step is one operation on all of a length. Those
    of 32 bytes and more, which are few among word n-grams, go to the library.
    """
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(np.minimum(lengths, _STRIPE).astype(np.uint8), kind="stable")
    edges = np.searchsorted(lengths[order].clip(max=_STRIPE), np.arange(1, _STRIPE + 1))
    eights, fours = _at(data, "<u8"), _at(data, "<u4")
    with np.errstate(over="ignore"):
        for length in range(1, _STRIPE):
            which = order[edges[length - 1] : edges[length]]
            if not len(which):
                continue
            at = starts[which]
            h = np.full(len(at), _P5 + np.uint64(length), np.uint64)
            done = 0
            while done + 8 <= length:
                h ^= _turn(eights[at + done] * _P2, 31) * _P1
                h = _turn(h, 27) * _P1 + _P4
                done += 8
            if done + 4 <= length:
                h ^= fours[at + done].astype(np.uint64) * _P1
                h = _turn(h, 23) * _P2 + _P3
                done += 4
            for k in range(done, length):
                h ^= data[at + k].astype(np.uint64) * _P5
                h = _turn(h, 11) * _P1
            h = (h ^ (h >> np.uint64(33))) * _P2
            h = (h ^ (h >> np.uint64(29))) * _P3
            out[which] = h ^ (h >> np.uint64(32))
    whole = memoryview(data)
    for i in order[edges[-1] :].tolist():
        out[i] = xxhash.xxh64_intdigest(whole[starts[i] : starts[i] + lengths[i]])
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the slices at ``a`` and ``b`` are equal, eight bytes at a time."""
    eights = _at(data, "<u8")
    short = np.minimum(lengths, 8).astype(np.uint64) * np.uint64(8)
    mask = np.uint64(2**64 - 1) >> (np.uint64(64) - short)
    equal = ((eights[a] ^ eights[b]) & mask) == 0
    # The last eight bytes may overlap those before.
    left, step = np.flatnonzero(equal & (lengths > 8)), 8
    while len(left):
        place = np.minimum(step, lengths[left] - 8)
        fits = eights[a[left] + place] == eights[b[left] + place]
        equal[left[~fits]] = False
        left = left[fits & (lengths[left] > step + 8)]
        step += 8
    return equal


@cache
def _zeros() -> np.ndarray:
    """For each length, byte of the CRC and its value: what it becomes after so many zero bytes."""
    value = np.arange(256, dtype=np.uint32)
    one = value.copy()
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    out = np.empty((_SHIFTS, 4, 256), np.uint32)
    out[0] = [value << np.uint32(8 * k) for k in range(4)]
    for n in range(1, _SHIFTS):
        out[n] = one[out[n - 1] & 0xFF] ^ (out[n - 1] >> np.uint32(8))
    return out


def crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of many slices, the short ones a byte at a time for all that are so long."""
    order = np.argsort(np.minimum(lengths, _STRIPE).astype(np.uint8), kind="stable")
    edges = np.searchsorted(lengths[order].clip(max=_STRIPE), np.arange(_STRIPE + 1))
    low, high = _zeros()[1, 0], np.uint32(0xFFFFFFFF)
    value = np.full(edges[-1], high, np.uint32)
    at = starts[order[: edges[-1]]]
    for k in range(_STRIPE - 1):
        more = slice(edges[k + 1], edges[-1])
        value[more] = low[(value[more] ^ data[at[more] + k]) & np.uint32(0xFF)] ^ (value[more] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order[: edges[-1]]] = value ^ high
    whole = memoryview(data)
    for i in order[edges[-1] :].tolist():
        out[i] = zlib.crc32(whole[starts[i] : starts[i] + lengths[i]])
    return out


def joined_crc(left: np.ndarray, right: np.ndarray, right_lengths: np.ndarray | int) -> np.ndarray:
    """CRC-32 of two byte strings in a row from theirs, for right parts of less than 64 bytes."""
    table = _zeros()
    out = right
    for k in range(4):
        out = out ^ table[right_lengths, k, (left >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


def _spaced(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of words with a space before, from theirs."""
    return joined_crc(np.full(len(crc), _SPACE), crc, lengths)


@dataclass
class Block:
    """A table: ``buckets`` and ``counts`` by slot; ``slots`` of the occurrences, and the text of each."""

    buckets: np.ndarray
    counts: np.ndarray
    slots: np.ndarray
    texts: np.ndarray


def intern(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot number of each occurrence, and the occurrence that owns each slot.

    Linear probing, all occurrences at once: whoever finds a free place claims it, one
    claim stands, and those that differ from the owner move on by one place.
    """
    size = 1 << max(4, (2 * len(keys) - 1).bit_length())
    owner = np.full(size, -1, np.int32)
    place = (keys & np.uint64(size - 1)).astype(np.int64)
    left = np.arange(len(keys))
    while len(left):
        at = place[left]
        free = owner[at] < 0
        owner[at[free]] = left[free]
        held = owner[at]
        equal = held == left
        maybe = np.flatnonzero(~equal & (keys[held] == keys[left]) & (lengths[held] == lengths[left]))
        equal[maybe] = same_bytes(data, starts[held[maybe]], starts[left[maybe]], lengths[left[maybe]])
        left = left[~equal]
        place[left] = (place[left] + 1) & (size - 1)
    taken = owner >= 0
    return (np.cumsum(taken) - 1)[place], owner[taken]


def _block(data, starts, ends, text_ends, texts, lo: int, hi: int, n_buckets: int) -> Block:
    """The n-grams that start with the words from ``lo`` to ``hi``."""
    first = np.arange(lo, hi)
    fits = [first[first + n <= text_ends[lo:hi]] for n in range(1, LONGEST + 1)]
    word = np.concatenate(fits)
    size = np.repeat(np.arange(1, LONGEST + 1), [len(f) for f in fits])
    begin, length = starts[word], ends[word + size - 1] - starts[word]
    slots, owners = intern(data, begin, length, xxhash64(data, begin, length))
    # Each distinct word's CRC, alone and after a space; longer n-grams are put together from these.
    n, crc = size[owners], np.zeros(len(owners), np.uint32)
    single = np.flatnonzero(n == 1)
    crc[single] = crc32(data, begin[owners[single]], length[owners[single]])
    near = min(hi + LONGEST - 1, len(starts))
    beyond = np.arange(hi, near)
    alone = np.concatenate((crc[slots[: hi - lo]], crc32(data, starts[beyond], ends[beyond] - starts[beyond])))
    more = ends[lo:near] - starts[lo:near]
    for k in range(2, LONGEST + 1):
        which = np.flatnonzero(n == k)
        at = word[owners[which]] - lo
        # A long word's CRC cannot be appended by lookup; its n-grams are read whole.
        short = np.all([more[at + j] < _SHIFTS - 1 for j in range(1, k)], axis=0) if len(at) else np.zeros(0, bool)
        at, value = at[short], alone[at[short]]
        for j in range(1, k):
            value = joined_crc(value, _spaced(alone[at + j], more[at + j]), more[at + j] + 1)
        crc[which[short]] = value
        crc[which[~short]] = crc32(data, begin[owners[which[~short]]], length[owners[which[~short]]])
    return Block((crc % np.uint32(n_buckets)).astype(np.int64), np.bincount(slots, minlength=len(owners)), slots, texts[word])


def tables(column: pa.Array, n_buckets: int, block_words: int = BLOCK_WORDS) -> Iterator[tuple[np.ndarray, Iterator[Block]]]:
    """The number of words of each text, and the tables of its n-grams.

    Memory is that of the texts and of one block of words; a text longer than a block has
    several, so a text of any length fits.
    """
    raw, text_starts = joined_bytes(column)
    low = _LOWER[raw]
    inside = _IN_WORD[low]
    # Words with one space after each, one before the first, and room for whole reads at the end.
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    data = np.concatenate(([np.uint8(0x20)], np.where(inside, low, np.uint8(0x20))[kept], np.zeros(8, np.uint8)))
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
    raw_starts = np.flatnonzero(edges == 1)
    gaps = np.flatnonzero(data[:-8] == 0x20)
    starts, ends = gaps[:-1] + 1, gaps[1:]
    bounds = np.searchsorted(raw_starts, text_starts)
    counts = np.diff(bounds)
    texts = np.repeat(np.arange(len(counts)), counts)
    text_ends = np.repeat(bounds[1:], counts)

    def blocks() -> Iterator[Block]:
        for lo in range(0, len(starts), block_words):
            yield _block(data, starts, ends, text_ends, texts, lo, min(lo + block_words, len(starts)), n_buckets)

    return counts, blocks()
