"""Static range asymmetric numeral system over token ids, many lanes at a time.

A table of integer frequencies that sum to 2**BITS is shared by all blocks. A
block deals its ids to lanes in turn; each lane has its own 64-bit state, and
all lanes move one id per numpy step. Lanes emit 32-bit words to one stream;
the encoder walks backwards, so the decoder reads forwards. A block stores the
lane states at its start and at checkpoints every CHECKPOINT steps with their
word positions, so its sections can be decoded apart from each other, and
checksums of the stream and of the ids.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

BITS = 18
LANES = 2048
CHECKPOINT = 256
_LOW = np.uint64(1 << 31)
_LIMIT = np.uint64(((1 << 31) >> BITS) << 32)
_32 = np.uint64(32)
_BITS = np.uint64(BITS)
_WORD = np.uint64(0xFFFFFFFF)
_SLOT = np.uint64((1 << BITS) - 1)
_HEAD = struct.Struct("<4sIQIIIIII")
_MAGIC = b"RNS1"


@dataclass
class Table:
    freq: np.ndarray  #: uint32 per symbol, sum 2**BITS
    cum: np.ndarray
    symbol: np.ndarray  #: per slot
    slot_freq: np.ndarray
    slot_bias: np.ndarray
    crc: int


def normalised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**BITS, at least one for each symbol that occurs."""
    total, size = int(counts.sum()), 1 << BITS
    if total == 0:
        counts, total = np.eye(1, len(counts), 0, dtype=np.int64)[0], 1
    if int((counts > 0).sum()) > size:
        raise ValueError(f"more than {size} symbols occur")
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts * (size / total))), 0).astype(np.int64)
    rest = size - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest >= 0:
        freq[order[0]] += rest
    else:  # take from the largest, never below one
        for k in order:
            take = min(-rest, int(freq[k]) - 1)
            freq[k] -= take
            rest += take
            if rest == 0:
                break
    return freq


def make_table(freq: np.ndarray) -> Table:
    freq = np.asarray(freq, np.int64)
    cum = np.cumsum(freq) - freq
    symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    return Table(freq.astype(np.uint64), cum.astype(np.uint64), symbol, freq[symbol].astype(np.uint64),
                 (np.arange(1 << BITS) - cum[symbol]).astype(np.uint64), zlib.crc32(freq.astype("<u4").tobytes()))


def encode(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = min(LANES, max(1, 1 << max(0, (n // CHECKPOINT).bit_length())))
    steps = -(-n // lanes)
    freq, cum = table.freq[ids], table.cum[ids]
    if n and int(freq.min()) == 0:
        raise ValueError("a token has no place in the table")
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = [np.zeros(0, np.uint32)] * steps
    saved: dict[int, np.ndarray] = {}
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes:(t + 1) * lanes], cum[t * lanes:(t + 1) * lanes]
        x = state[:len(f)]
        over = x >= f * _LIMIT
        words[t] = (x[over] & _WORD).astype(np.uint32)
        x = np.where(over, x >> _32, x)
        q = x // f
        state[:len(f)] = (q << _BITS) + (x - q * f) + c
        if t % CHECKPOINT == 0:
            saved[t] = state.copy()
    saved.setdefault(0, state)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.uint64)
    points = sorted(saved)
    stream = np.concatenate([*words, np.zeros(0, np.uint32)]).astype("<u4").tobytes()
    body = b"".join([np.array([at[t] for t in points], "<u8").tobytes(),
                     *(saved[t].astype("<u8").tobytes() for t in points), stream])
    head = _HEAD.pack(_MAGIC, BITS, n, lanes, len(points), CHECKPOINT, table.crc, zlib.crc32(body),
                      zlib.crc32(ids.astype("<u4").tobytes()))
    return head + body


@dataclass
class Block:
    """A parsed block; ``section`` decodes one part by itself."""

    n: int
    lanes: int
    every: int
    positions: np.ndarray
    states: np.ndarray
    words: np.ndarray
    ids_crc: int

    def section(self, k: int, table: Table) -> np.ndarray:
        """The ids from checkpoint k to the next."""
        x, at = self.states[k].copy(), int(self.positions[k])
        first = k * self.every * self.lanes
        last = min(self.n, (k + 1) * self.every * self.lanes)
        out = np.empty(last - first, np.uint32)
        for a in range(0, last - first, self.lanes):
            m = min(self.lanes, last - first - a)
            y = x[:m]
            slot = (y & _SLOT).astype(np.int64)
            out[a:a + m] = table.symbol[slot]
            y = table.slot_freq[slot] * (y >> _BITS) + table.slot_bias[slot]
            under = np.flatnonzero(y < _LOW)
            y[under] = (y[under] << _32) | self.words[at:at + len(under)]
            at += len(under)
            x[:m] = y
        return out


def parse(raw: bytes, table: Table) -> Block:
    magic, bits, n, lanes, points, every, table_crc, body_crc, ids_crc = _HEAD.unpack_from(raw)
    body = memoryview(raw)[_HEAD.size:]
    if magic != _MAGIC or bits != BITS or table_crc != table.crc:
        raise ValueError("the block was written with another format or table")
    if zlib.crc32(body) != body_crc:
        raise ValueError("the block is damaged")
    positions = np.frombuffer(body, "<u8", points)
    states = np.frombuffer(body, "<u8", points * lanes, 8 * points).reshape(points, lanes)
    return Block(n, lanes, every, positions, states, np.frombuffer(body, "<u4", offset=8 * points * (lanes + 1)), ids_crc)


def decode(raw: bytes, table: Table) -> np.ndarray:
    block = parse(raw, table)
    ids = np.concatenate([np.zeros(0, np.uint32), *(block.section(k, table) for k in range(len(block.positions)))])
    if len(ids) != block.n or zlib.crc32(ids.astype("<u4").tobytes()) != block.ids_crc:
        raise ValueError("the block does not decode to its checksum")
    return ids
