"""What Python workers keep between batches and tasks, bounded in bytes."""

from __future__ import annotations

import ctypes
import gc
from binascii import a2b_base64, b2a_base64

import pyarrow as pa

# About what a dictionary entry, a string and a byte string take beside their contents.
_ENTRY_BYTES = 190


class Memo(dict):
    """Results by word, of the words met first, which are mostly the frequent ones.

    Once its entries take ``limit`` bytes, it learns no more.
    """

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.room = limit

    def learn(self, key: str, value: bytes) -> None:
        size = _ENTRY_BYTES + 2 * len(key) + len(value)
        if size <= self.room:
            self.room -= size
            self[key] = value


# Bytes that a byte string and its place in a list take, and those of a full string of words.
_STRING_BYTES, _FULL_BYTES = 56, 256


class PackedMemo:
    """Results by word, of the words met first, which are mostly the frequent ones.

    Words of one hash share a byte string, ``  word result  word result ``, so that a word takes
    some 40 bytes instead of the 150 of a dictionary entry with its two objects. Words hold no
    blank and are not empty; results are written without blanks. Two blanks come before words only.
    Once its strings take ``limit`` bytes, it learns no more.
    """

    def __init__(self, limit: int) -> None:
        self.strings = [b" "] * max(1, limit // _FULL_BYTES)
        self.room = limit - _STRING_BYTES * len(self.strings)

    def get(self, word: str) -> bytes | None:
        string, key = self.strings[hash(word) % len(self.strings)], b"  %b " % word.encode()
        at = string.find(key)
        if at < 0:
            return None
        at += len(key)
        return a2b_base64(string[at : string.index(b" ", at)])

    def learn(self, word: str, result: bytes) -> None:
        """Remember the result of a word that is not known yet."""
        entry = b" %b %b " % (word.encode(), b2a_base64(result, newline=False))
        if len(entry) <= self.room:
            self.room -= len(entry)
            self.strings[hash(word) % len(self.strings)] += entry


def release() -> None:
    """Give back what an earlier task of this worker has freed but its allocators still hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library
