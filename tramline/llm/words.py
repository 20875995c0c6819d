"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of a batch.

Texts stay in one byte buffer with their offsets, as Arrow holds them. A word
is a run of bytes of one class; its hash sums a random 64-bit value per byte
times a power for its place in the word, so a whole batch takes a few passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; one longer text is handled alone. Hashing takes about 100 bytes for each.
SLICE_BYTES = 512 << 10

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NGRAM = _RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)

_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
#: After ``LOWER``: digits, letters, and all bytes of characters beyond ASCII.
WORD_BYTES = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
#: All but space and \t \n \v \f \r.
NON_SPACE = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))

_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def unmix(x: np.ndarray) -> np.ndarray:
    """The values that ``mix`` spreads to ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    return x ^ (x >> np.uint64(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


@dataclass
class Runs:
    """Runs of one byte class: byte places, the row each belongs to, runs per row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    per_row: np.ndarray
    first: np.ndarray  #: index of each row's first run, n + 1 values


def runs(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Runs:
    """Maximal runs of the bytes for which ``member`` (256 flags) holds, within rows."""
    n = len(offsets) - 1
    inside = np.zeros(len(buf) + 1, np.bool_)
    inside[:-1] = member[buf]
    cut = np.zeros(len(buf) + 1, np.bool_)
    cut[offsets] = True
    before = np.zeros(len(buf) + 1, np.bool_)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (cut | ~before))
    end = np.flatnonzero(before & (cut | ~inside))
    first = np.searchsorted(start, offsets)
    per_row = np.diff(first)
    return Runs(start, end, np.repeat(np.arange(n), per_row), per_row, first)


def run_hashes(buf: np.ndarray, r_start: np.ndarray, r_end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes; equal bytes have equal hashes."""
    if len(r_start) == 0:
        return np.zeros(0, np.uint64)
    length = r_end - r_start
    total = np.zeros(int(length.sum()) + 1, np.uint64)
    at = np.cumsum(length) - length
    place = np.arange(len(total) - 1) - np.repeat(at, length)
    table = powers(int(length.max()))
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[buf[np.repeat(r_start - at, length) + np.arange(len(total) - 1)]] * table[place], out=total[1:])
        return mix(total[at + length] - total[at] + length.astype(np.uint64))


def ngram_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """The hash of n consecutive words for each place (len - n + 1 values)."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(m, np.uint64)
        for k in range(n):
            out += word_hash[k:k + m] * _NGRAM[k]
        return mix(out)


def per_row_sum(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of 0/1 flags of each row's bytes (or runs)."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
