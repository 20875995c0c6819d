"""Packing documents into sequences of a fixed length, by bounded-space online best fit.

Each task reads its rows in order and turns a text into token ids and the end
id; only what exceeds the capacity is cut, into pieces of full capacity and a
rest. A piece goes into the open bin with the least room that still holds it.
Bins are found through a bitset with one bit per amount of free room, so a
lookup is a shift and a lowest bit. A fixed number of bins is open; when a new
one is needed beyond that, the fullest closes first.

A piece's place is final once it is read: memory is the open bins and one
slice of a batch, nothing is shuffled, and a task that is run again packs its
rows by itself. Each task leaves its open bins partly empty, a few sequences
for each partition.

Defined cases: a null or empty text has no ids but the end id. Repeated rows
and ids are packed like others. No rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tramline.llm.chunks import load
from tramline.llm.common import with_python
from tramline.llm.words import row_slices, text_buffer

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 2048


class BestFit:
    """Open bins by free room; ``place`` gives a piece its bin and the offset there."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.limit = capacity, open_bins
        self.rooms = 0  # bit f: some open bin has f places free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0

    def _take(self, room: int) -> int:
        bins = self.bins[room]
        got = bins.pop()
        if not bins:
            self.rooms &= ~(1 << room)
        self.n_open -= 1
        return got

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(room)
        else:
            if self.n_open >= self.limit:
                self._take((self.rooms & -self.rooms).bit_length() - 1)
            room, bin_id = self.capacity, self.n_bins
            self.n_bins += 1
        left = room - length
        if left:
            self.bins[left].append(bin_id)
            self.rooms |= 1 << left
            self.n_open += 1
        return bin_id, self.capacity - room


def pack_documents(docs: DataFrame, tokenizer: str, ids: bool = True, capacity: int = CAPACITY,
                   end_id: int = END_ID, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]).

    ``tokenizer`` is the path of the word-level vocabulary. ``ids`` adds the
    piece's token ids. ``sequence_id`` is unique over all tasks.
    """
    with_python(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * ids
    schema = (f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
              + ", ids array<int>" * ids)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = load(tokenizer, True), BestFit(capacity, open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for i, j in row_slices(off):
                flat, at = encoder.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                flat = np.insert(flat, at[1:], end_id)
                at = at + np.arange(len(at))
                raw = flat.astype("<u4").tobytes()
                row, piece, start, length, crc, seq, place = [], [], [], [], [], [], []
                for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    for p, s in enumerate(range(a, b, capacity)):
                        n = min(capacity, b - s)
                        bin_id, offset = packer.place(n)
                        row.append(k)
                        piece.append(p)
                        start.append(s - a)
                        length.append(n)
                        crc.append(zlib.crc32(raw[4 * s:4 * (s + n)]))
                        seq.append(first + bin_id)
                        place.append(offset)
                cols = [batch.column(0).slice(i, j - i).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, seq, place))]
                if ids:
                    edges = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(flat.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(work, schema)
