"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers encode space+text: A is byte-level, B writes the space itself.
Tokens become byte ranges. Two as-of merges, keyed by document, find for every
token start the other side's token that covers it: once from A's starts, once
from B's. Two ranges overlap exactly if one of them starts inside the other,
so the union of both directions is the links. Where both sides end at the
same byte a group of tokens closes.

One pass over the texts writes a row per document with its distinct linked id
pairs and their times; pair counts over the corpus are summed from that table,
and joined back to it pair by pair. Texts are encoded once and never shuffled.
The counts are broadcast only if they have few rows; else the same join
shuffles (document, pair) rows.

Memory of a task: one slice of half a megabyte of text (or one longer text)
and the chunk caches of the tokenizers.

Defined cases: a null or empty text, and one whose joined token bytes on
either side differ from space+text (a text with U+2581, which B reads as a
space), has no tokens: zeros, and an empty digest. Special-token strings are
plain text. Repeated rows and ids, null ids included, are rows of their own.
No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.chunks import _SYMBOL, ChunkTokenizer
from tramline.llm.common import broadcast_if_small, settle, with_python
from tramline.llm.words import row_slices, text_buffer

SPACE = 32
META = "▁"


class ByteTokenizer(ChunkTokenizer):
    """The byte-level side; special-token strings are plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path, False)
        self.tokenizer.encode_special_tokens = True

    def token_bytes(self) -> list[bytes]:
        value = {c: b for b, c in enumerate(_SYMBOL)}
        out = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items():
            out[k] = bytes(value[c] for c in token)
        return out


class PieceTokenizer(ChunkTokenizer):
    """The piece side, for texts that already start with the space it would add.

    No piece has a space behind another character, so a space behind another
    character is a plain cut; the library encodes each distinct chunk once.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        self._clear()
        self.folds = False
        texts = [self.pieces.id_to_piece(k) for k in range(self.pieces.get_piece_size())]
        if any(META in t.lstrip(META) for t in texts if t):
            raise ValueError("pieces with inner spaces cannot be encoded chunk by chunk")
        self._texts = texts
        self._lone = self.pieces.piece_to_id(META)

    def token_bytes(self) -> list[bytes]:
        p = self.pieces
        return [bytes([int(t[3:5], 16)]) if p.is_byte(k) else b"" if p.is_control(k) or p.is_unknown(k)
                else t.replace(META, " ").encode() for k, t in enumerate(self._texts)]

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        got = self.pieces.encode([c[1:].decode() for c in chunks], num_threads=1)
        got = [g if len(c) > 1 else [self._lone] for g, c in zip(got, chunks, strict=True)]
        n = np.array([len(g) for g in got], np.int32)
        entry = (len(self._at) + np.arange(len(got))).astype(np.int32)
        self._at = np.concatenate([self._at, (len(self._ids) + np.cumsum(n) - n).astype(np.int32)])
        self._len = np.concatenate([self._len, n])
        self._ids = np.concatenate([self._ids, np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(n.sum()))])
        keys = np.concatenate([self._keys, hashes])
        order = np.argsort(keys, kind="stable")
        self._keys, self._entry = keys[order], np.concatenate([self._entry, entry])[order]

    def _chunks(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = buf == SPACE
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[off[:-1]] = True
        at = np.flatnonzero(cut)
        return at, np.append(at[1:], len(buf)), np.zeros(len(off) - 1, np.bool_)


class Side:
    """A tokenizer with its tokens' bytes, as one array with offsets."""

    def __init__(self, tokenizer: ChunkTokenizer) -> None:
        self.tokenizer = tokenizer
        table = tokenizer.token_bytes()
        self.size = len(table)
        self.length = np.array([len(t) for t in table], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their rows, and flags of the rows whose joined bytes are the text's."""
        ids, at = self.tokenizer.encode(buf, off)
        ids = ids.astype(np.int64)
        n = len(off) - 1
        row = np.repeat(np.arange(n), np.diff(at))
        length = self.length[ids]
        good = np.bincount(row, weights=length, minlength=n).astype(np.int64) == np.diff(off)
        pick = good[row]
        ids_, length_ = ids[pick], length[pick]
        end = np.cumsum(length_)
        got = self.bytes[np.repeat(self.first[ids_] - (end - length_), length_) + np.arange(int(length_.sum()))]
        place = np.repeat(good, np.diff(off))
        wrong = np.flatnonzero(place)[got != buf[place]]
        good[np.searchsorted(off, wrong, side="right") - 1] = False
        return ids, row, good


_SIDES: dict[str, Side] = {}


def load_side(path: str, make: type[ChunkTokenizer]) -> Side:
    """One per Python worker; its cache serves all its tasks."""
    if path not in _SIDES:
        _SIDES[path] = Side(make(path))
    return _SIDES[path]


def with_lead(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    return np.insert(buf, off[:-1], SPACE), off + np.arange(len(off))


def covering(row: np.ndarray, start: np.ndarray, other_row: np.ndarray, other_start: np.ndarray) -> np.ndarray:
    """For each token start, the place of the other side's token that covers it."""
    here = pd.DataFrame({"row": row, "at": start})
    there = pd.DataFrame({"row": other_row, "at": other_start, "token": np.arange(len(other_start))})
    return pd.merge_asof(here, there, on="at", by="row")["token"].to_numpy(np.int64)


class Alignment:
    """Tokens, links and groups of the texts of a slice."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, a: Side, b: Side) -> None:
        self.n = len(off) - 1
        text_length = np.diff(off)
        buf, off = with_lead(buf, off)
        ids_a, row_a, good_a = a.encode(buf, off)
        ids_b, row_b, good_b = b.encode(buf, off)
        good = good_a & good_b & (text_length > 0)
        keep_a, keep_b = good[row_a], good[row_b]
        self.a, self.row_a, self.b, self.row_b = ids_a[keep_a], row_a[keep_a], ids_b[keep_b], row_b[keep_b]
        len_a, len_b = a.length[self.a], b.length[self.b]
        end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
        start_a, start_b = end_a - len_a, end_b - len_b
        over_a = covering(self.row_a, start_a, self.row_b, start_b)
        over_b = covering(self.row_b, start_b, self.row_a, start_a)
        own = start_a[over_b] != start_b  # equal starts are in the first direction already
        self.link_a = np.concatenate([np.arange(len(self.a)), over_b[own]])
        self.link_b = np.concatenate([over_a, np.flatnonzero(own)])
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        last = np.cumsum(np.diff(off) * good)  # where each kept row ends, the kept ones lying end to end
        self.n_groups = np.diff(np.searchsorted(shared, last, side="right"), prepend=0)

    def per_row(self, row: np.ndarray) -> np.ndarray:
        return np.bincount(row, minlength=self.n).astype(np.int64)

    def pairs(self, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (row, id pair as a * size_b + b) of the links and their times, by row."""
        key = self.a[self.link_a] * size_b + self.b[self.link_b]
        both, times = np.unique((self.row_a[self.link_a] << 32) | key, return_counts=True)
        return both >> 32, both & 0xFFFFFFFF, times

    def group_texts(self, strings: np.ndarray, size: int) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each row; ``strings`` holds str(id) followed by ',', '|' and ';', ``size`` of each."""
        n_a, n_b = len(self.a), len(self.b)
        if n_a == 0:
            return [""] * self.n
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)
        out = np.empty(n_a + n_b, np.int64)
        out[np.arange(n_a) + np.searchsorted(self.group_b, self.group_a, side="left")] = self.a + size * last_a
        out[np.arange(n_b) + np.searchsorted(self.group_a, self.group_b, side="right")] = self.b + 2 * size * last_b
        parts = strings[out].tolist()
        edges = np.concatenate([[0], np.cumsum(self.per_row(self.row_a) + self.per_row(self.row_b))]).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in itertools.pairwise(edges)]


def _id_strings(size: int) -> np.ndarray:
    names = [str(k) for k in range(size)]
    return np.array([x + s for s in ",|;" for x in names], dtype=object)


def link_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every document."""
    with_python(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = load_side(byte_path, ByteTokenizer), load_side(piece_path, PieceTokenizer)
        size = max(a.size, b.size)
        strings = _id_strings(size)
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for i, j in row_slices(off):
                got = Alignment(buf[off[i]:off[j]], off[i:j + 1] - off[i], a, b)
                row, key, times = got.pairs(b.size)
                edges = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))]), pa.int32())
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in got.group_texts(strings, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + np.arange(j - i)), batch.column(0).slice(i, j - i), pa.array(got.per_row(got.row_a)),
                     pa.array(got.per_row(got.row_b)), pa.array(got.n_groups.astype(np.int64)),
                     pa.array(got.per_row(got.row_a[got.link_a])), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(edges, pa.array(key, pa.int64())),
                     pa.ListArray.from_arrays(edges, pa.array(times, pa.int32()))], names=names)
                at += j - i

    return docs.select("doc_id", "text").mapInArrow(
        work, f"row long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<long>, times array<int>")


def pair_counts(linked: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold the pair, and whether no pair of its B id has more."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            keys, place = np.unique(pair, return_inverse=True)
            n = np.bincount(place, weights=batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n.astype(np.int64))], names=["pair", "n"])

    counts = settle(linked.select("pairs", "times").mapInArrow(work, "pair long, n long")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return settle(counts.withColumn("b", F.col("pair") % size_b).join(most, "b")
                  .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``n_best``: links whose pair is the commonest of its B id in the corpus,
    ties included. ``count_sum``: the pair counts of all links, added up.
    """
    linked = settle(link_documents(docs, byte_path, piece_path), "linked")
    counts = pair_counts(linked, load_side(piece_path, PieceTokenizer).size)
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    sums = each.join(broadcast_if_small(counts), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return linked.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
