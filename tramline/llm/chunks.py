"""Token ids of many texts with a public tokenizer, word by word from a cache.

The tokenizers split a text before they merge, and never merge over such a
cut. At cuts that are plain from ASCII bytes alone (white space; between
letters, digits and punctuation) a batch is cut into chunks; each distinct
chunk is encoded once by the tokenizers library and its ids are kept, so a
text's ids are those of its chunks in order. Where a cut would not be plain
(special-token markers, white space beyond ASCII beside words)
the library encodes the whole text. The cache is dropped when it has grown to
CACHE chunks (or eight ids for each); that changes no result.
"""

from __future__ import annotations

import os

import numpy as np

from tramline.llm.words import LOWER, run_hashes

CACHE = 2_000_000

LETTER, DIGIT, PUNCT, OPAQUE, SPACE, HIGH = range(6)
_CLASS = np.full(256, OPAQUE, np.uint8)  # quotes (contractions) and control characters
_CLASS[33:127] = PUNCT
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[39] = OPAQUE
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[128:] = HIGH
_PLAIN_CUT = np.zeros((6, 6), np.bool_)
for _a in (LETTER, DIGIT, PUNCT):
    for _b in (LETTER, DIGIT, PUNCT):
        _PLAIN_CUT[_a, _b] = _a != _b


def _byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte (a public rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


_SYMBOL = _byte_symbols()


def _wide_space(buf: np.ndarray) -> np.ndarray:
    """Flags of bytes that start a white-space character beyond ASCII."""
    out = np.zeros(len(buf), np.bool_)
    at = np.flatnonzero((buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3)))
    a, b, c = buf[at], buf[np.minimum(at + 1, len(buf) - 1)], buf[np.minimum(at + 2, len(buf) - 1)]
    out[at] = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | (
        (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | (
        (a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return out


class ChunkTokenizer:
    """Encodes texts by chunks.

    ``folds``: the tokenizer lower-cases, drops white space and takes digits one
    by one (the word-level vocabulary); else a space leads the word after it
    (the byte-level vocabulary).
    """

    def __init__(self, path: str, folds: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.folds = folds
        self._cut = _PLAIN_CUT.copy()
        self._cut[DIGIT, DIGIT] = folds
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._entry = np.zeros(0, np.int32)
        self._at = np.zeros(0, np.int32)
        self._len = np.zeros(0, np.int32)
        self._ids = np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _one(self, raw: bytes) -> list[int] | None:
        """Ids of a chunk that is a single word for the tokenizer; None if that is not plain."""
        body = raw[1:] if raw[:1] == b" " else raw
        kinds = set(_CLASS[np.frombuffer(body, np.uint8)].tolist())
        if kinds == {LETTER} or kinds == {PUNCT} or (kinds == {DIGIT} and not self.folds):
            pass
        elif kinds <= {LETTER, HIGH} and kinds:
            word = body.decode()
            if not word.isalpha() or any("\xff" < c for c in word):
                return None
            if self.folds:
                raw = word.lower().encode()
        else:
            return None
        return [t.id for t in self.model.tokenize("".join([_SYMBOL[b] for b in raw]))]

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        got = [self._one(c) for c in chunks]
        rest = [k for k, g in enumerate(got) if g is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast(
                [chunks[k].decode() for k in rest], add_special_tokens=False), strict=True):
            got[k] = e.ids
        n = np.array([len(g) for g in got], np.int32)
        at = (len(self._ids) + np.cumsum(n) - n).astype(np.int32)
        entry = (len(self._at) + np.arange(len(got))).astype(np.int32)
        self._ids = np.concatenate([self._ids, np.array([i for g in got for i in g], np.uint32)])
        self._at, self._len = np.concatenate([self._at, at]), np.concatenate([self._len, n])
        keys = np.concatenate([self._keys, hashes])
        order = np.argsort(keys, kind="stable")
        self._keys, self._entry = keys[order], np.concatenate([self._entry, entry])[order]

    def _chunks(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every chunk, and flags of the texts that need the library as a whole."""
        n = len(buf)
        kind = _CLASS[buf]
        first = np.zeros(n + 1, np.bool_)
        first[off] = True  # a text starts here
        ws = kind == SPACE
        prev_ws, next_ws = np.zeros(n, np.bool_), np.zeros(n, np.bool_)
        prev_ws[1:] = ws[:-1] & ~first[1:n]
        next_ws[:-1] = ws[1:] & ~first[1:n]
        ends_text = first[1:]
        cut = np.zeros(n, np.bool_)
        cut[1:] = self._cut[kind[:-1], kind[1:]]
        cut |= first[:n]
        marker = np.zeros(n, np.bool_)
        marker[:-1] = (buf[:-1] == 60) & (buf[1:] == 124) & ~first[1:n]  # "<|"
        bad = marker
        if self.folds:
            start = ~ws & (cut | prev_ws)
            at = np.flatnonzero(start)
            stop = start.copy()
            stop |= ws
            stop |= first[:n]
            marks = np.append(np.flatnonzero(stop), n)
            end = marks[np.searchsorted(marks, at, side="right")]
        else:
            prev_space = np.zeros(n, np.bool_)
            prev_space[1:] = (buf[:-1] == 32) & ~first[1:n]
            last = ws & ~next_ws & ~ends_text
            start = np.where(ws, ~prev_ws | last, (cut & ~prev_ws) | (prev_ws & ~prev_space)) | first[:n]
            at = np.flatnonzero(start)
            end = np.append(at[1:], n)
            bad = bad | _wide_space(buf)
        row = np.searchsorted(off, np.flatnonzero(bad), side="right") - 1
        whole = np.zeros(len(off) - 1, np.bool_)
        whole[row] = True
        return at, end, whole

    def _entries(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cache entries of the distinct chunks, the chunks' places among them, their rows, and whole-text flags."""
        at, end, whole = self._chunks(buf, off)
        row = np.searchsorted(off, at, side="right") - 1
        keep = ~whole[row]
        at, end, row = at[keep], end[keep], row[keep]
        src = LOWER[buf] if self.folds else buf
        hashes, pick, inverse = np.unique(run_hashes(src, at, end), return_index=True, return_inverse=True)
        if len(self._keys) > CACHE or len(self._ids) > 8 * CACHE:
            self._clear()
        place = np.searchsorted(self._keys, hashes)
        known = np.zeros(len(hashes), np.bool_)
        inside = place < len(self._keys)
        known[inside] = self._keys[place[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = src.tobytes()
            self._learn(hashes[new], [raw[at[k]:end[k]] for k in pick[new].tolist()])
            place = np.searchsorted(self._keys, hashes)
        return self._entry[place] if len(hashes) else np.zeros(0, np.int64), inverse, row, whole

    def _gather(self, entry: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self._ids[np.repeat(self._at[entry] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]

    def count(self, buf: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
        """How often each of ``size`` ids occurs in all texts."""
        out = np.zeros(size, np.int64)
        if len(buf) == 0:
            return out
        entry, inverse, _, whole = self._entries(buf, off)
        count = self._len[entry]
        times = np.repeat(np.bincount(inverse, minlength=len(entry)), count)
        out += np.bincount(self._gather(entry, count), weights=times, minlength=size).astype(np.int64)
        raw = buf.tobytes() if whole.any() else b""
        for k in np.flatnonzero(whole).tolist():
            out += np.bincount(self.whole(raw[off[k]:off[k + 1]].decode()), minlength=size)
        return out

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts, one after the other, and their n + 1 offsets."""
        n = len(off) - 1
        if len(buf) == 0:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        entry, inverse, row, whole = self._entries(buf, off)
        entry = entry[inverse]
        count = self._len[entry]
        per_text = np.bincount(row, weights=count, minlength=n).astype(np.int64)
        ids = self._gather(entry, count)
        if whole.any():
            pieces, at_id = [], np.concatenate([[0], np.cumsum(per_text)])
            raw = buf.tobytes()
            for k in range(n):
                if whole[k]:
                    pieces.append(self.whole(raw[off[k]:off[k + 1]].decode()))
                    per_text[k] = len(pieces[-1])
                else:
                    pieces.append(ids[at_id[k]:at_id[k + 1]])
            ids = np.concatenate(pieces)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


_LOADED: dict[tuple[str, bool], ChunkTokenizer] = {}


def load(path: str, folds: bool) -> ChunkTokenizer:
    """One tokenizer per Python worker; its cache serves all its tasks."""
    if (path, folds) not in _LOADED:
        _LOADED[path, folds] = ChunkTokenizer(path, folds)
    return _LOADED[path, folds]
