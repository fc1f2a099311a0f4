"""Static range asymmetric numeral system over arrays of ids.

All blocks of a message share one frequency table. Each block holds its ids in
``LANES`` interleaved states, which take turns: id ``k`` of a block belongs to lane
``k % LANES``. A state is below 2**63 and is renewed by 32-bit words from the
block's own stream whenever it falls below 2**31. The states a block starts from and
the place of its words are its checkpoint, and a checksum covers both, so any block
can be decoded without the others; here numpy decodes all of them at once, lane by
lane.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 256
BLOCK_IDS = 1 << 16
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


@dataclass
class Table:
    """Symbols in ascending order, with frequencies that sum up to ``1 << bits``."""

    symbols: np.ndarray
    freqs: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        # At least sixteen slots a symbol, so that rare ones do not crowd out the others.
        bits = max(14, int(len(symbols)).bit_length() + 4)
        total = 1 << bits
        freqs = np.maximum(1, counts * total // counts.sum())
        spare = total - int(freqs.sum())
        if spare >= 0:
            freqs[freqs.argmax()] += spare
        else:
            # Rounding rare symbols up takes slots from frequent ones, in proportion.
            over = freqs - 1
            take = -(-over * -spare // over.sum())
            take = np.minimum(take, over)
            freqs -= take
            freqs[freqs.argmax()] += total - int(freqs.sum())
        return cls(symbols.astype(np.uint32), freqs.astype(np.uint32), bits)

    def pack(self) -> bytes:
        steps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        return zlib.compress(steps.tobytes() + self.freqs.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(data), "<u4").reshape(2, -1)
        freqs = both[1].astype(np.uint32)
        return cls(np.cumsum(both[0], dtype=np.uint32), freqs, int(freqs.sum()).bit_length() - 1)

    def starts(self) -> np.ndarray:
        return np.cumsum(self.freqs, dtype=np.uint64) - self.freqs


@dataclass
class Message:
    """Encoded ids. ``words`` of block ``b`` go from ``offsets[b]`` to ``offsets[b + 1]``."""

    n_ids: int
    table: bytes
    states: np.ndarray  # blocks x LANES
    offsets: np.ndarray
    words: np.ndarray
    checksums: np.ndarray


def _shape(n_ids: int) -> tuple[int, int]:
    """Blocks and steps per block; blocks are equally long, the last is filled up."""
    blocks = max(1, -(-n_ids // BLOCK_IDS))
    return blocks, -(-n_ids // (blocks * LANES))


def _checksum(states: np.ndarray, words: np.ndarray) -> int:
    return zlib.crc32(words.tobytes(), zlib.crc32(states.tobytes()))


def encode(ids: np.ndarray) -> Message:
    """Encode ids of a vocabulary that fits into memory as a list."""
    table = Table.of(ids)
    blocks, steps = _shape(len(ids))
    place = np.zeros(int(table.symbols[-1]) + 1, np.int64)
    place[table.symbols] = np.arange(len(table.symbols))
    filled = np.full(blocks * steps * LANES, int(table.freqs.argmax()), np.int64)
    filled[: len(ids)] = place[ids]
    filled = filled.reshape(blocks, steps, LANES)
    freqs, starts, bits = table.freqs.astype(np.uint64), table.starts(), np.uint64(table.bits)
    room = freqs << np.uint64(63 - table.bits)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    out, owner = [], []
    # A stable sort of 16-bit numbers takes linear time.
    number = np.arange(blocks, dtype=np.uint16 if blocks < 1 << 16 else np.int64).repeat(LANES).reshape(blocks, LANES)
    for step in range(steps - 1, -1, -1):
        symbol = filled[:, step]
        freq = freqs[symbol]
        full = state >= room[symbol]
        out.append(state[full].astype(np.uint32))
        owner.append(number[full])
        state = np.where(full, state >> _WORD, state)
        whole = state // freq
        state = (whole << bits) + (state - whole * freq) + starts[symbol]
    words, owner = np.concatenate(out[::-1]), np.concatenate(owner[::-1])
    words = words[np.argsort(owner, kind="stable")].astype("<u4")
    offsets = np.zeros(blocks + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=blocks), out=offsets[1:])
    states = state.astype("<u8")
    checksums = [_checksum(states[b], words[offsets[b] : offsets[b + 1]]) for b in range(blocks)]
    return Message(len(ids), table.pack(), states, offsets, words, np.array(checksums, np.int64))


def decode(message: Message) -> np.ndarray:
    """The ids again; a block that does not match its checksum is an error."""
    table = Table.unpack(message.table)
    blocks, steps = _shape(message.n_ids)
    words = message.words.astype(np.uint64)
    for b in range(blocks):
        part = message.words[message.offsets[b] : message.offsets[b + 1]]
        if _checksum(message.states[b], part) != message.checksums[b]:
            raise ValueError(f"block {b} is damaged")
    freqs, starts, bits = table.freqs.astype(np.uint64), table.starts(), np.uint64(table.bits)
    mask = np.uint64((1 << table.bits) - 1)
    of_slot = np.repeat(np.arange(len(freqs), dtype=np.int32), table.freqs)
    state = message.states.astype(np.uint64)
    at = message.offsets[:-1].copy()
    out = np.empty((blocks, steps, LANES), np.int32)
    for step in range(steps):
        slot = state & mask
        symbol = of_slot[slot.astype(np.int64)]
        out[:, step] = symbol
        state = freqs[symbol] * (state >> bits) + slot - starts[symbol]
        low = state < _LOW
        turn = np.cumsum(low, axis=1)
        place = (at[:, None] + turn - 1)[low]
        state[low] = (state[low] << _WORD) | words[place]
        at += turn[:, -1]
    return table.symbols[out.reshape(-1)[: message.n_ids]]
