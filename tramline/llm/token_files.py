"""Token ids of a corpus in binary files, coded by a static rANS.

Writing takes two passes. The first encodes every text and keeps the ids, two
bytes each, in a table under the shared scratch folder; counts over it (at most
the vocabulary's size of numbers come to the driver) give the shared frequency
table. The second sends the ids, not the texts, into ascending doc_id ranges
and writes blocks: a row holds the block's documents with their token counts
and the coded ids. Files are written by Spark's committer, so a lost task
leaves nothing half written.

Blocks decode independently. A document's start is the sum of the tokens of
earlier ranges, earlier blocks of its range and earlier documents of its
block; only counts are added up, and payloads are not shuffled.

Defined cases: a null or empty text is its end id alone. Rows with equal ids
stand in the order of a digest of their text, rows equal in both next to each
other; a null id comes first. No rows give files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm import rans
from tramline.llm.chunks import load
from tramline.llm.common import settle, with_python
from tramline.llm.words import row_slices, text_buffer

END_ID = 2
VOCABULARY = 50_257
#: How ids are kept between the passes; the vocabulary has less than 2**16.
PACKED = np.dtype("<u2")
#: A block closes with the document that brings it to so many ids.
BLOCK = 1 << 20

_TABLES: dict[int, rans.Table] = {}


def _table(freq: bytes) -> rans.Table:
    """The decoding table, made once per Python worker."""
    key = zlib.crc32(freq)
    if key not in _TABLES:
        _TABLES[key] = rans.make_table(np.frombuffer(freq, "<u4"))
    return _TABLES[key]


def _with_end(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(flat, at[1:], END_ID), at + np.arange(len(at))


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, tie, ids): each text's ids and the end id as little-endian 16-bit numbers; ``tie`` orders equal doc_ids."""
    with_python(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer, False)
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for i, j in row_slices(off):
                flat, at = _with_end(*encoder.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i]))
                packed = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer((2 * at).astype(np.int64)), pa.py_buffer(flat.astype(PACKED))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), packed.cast(pa.binary())],
                                                 names=["doc_id", "tie", "ids"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(work, f"doc_id {id_type}, tie long, ids binary")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and the n + 1 offsets."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    ids = np.frombuffer(data, PACKED, count=int(off[-1]) // 2)[int(off[0]) // 2:] if len(column) and off[-1] else np.zeros(0, PACKED)
    return ids, (off - off[0]) // 2


def count_tokens(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all texts, end ids included."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column(0))[0], minlength=VOCABULARY)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["id", "n"])

    counts = np.zeros(VOCABULARY, np.int64)
    for r in encoded.select("ids").mapInArrow(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n
    return counts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, block: int = BLOCK) -> None:
    """Write the ids of all texts, each with the end id, in ascending doc_id order under ``path``."""
    spark = docs.sparkSession
    encoded = settle(encode_documents(docs, tokenizer), "token-ids")
    freq = rans.normalised(count_tokens(encoded)).astype("<u4").tobytes()
    spark.createDataFrame([(bytearray(freq),)], "freq binary").write.mode("overwrite").parquet(f"{path}/table")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ordered = encoded.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = _table(freq), TaskContext.get().partitionId()
        held: list[tuple[pa.Array, np.ndarray]] = []
        pieces: list[np.ndarray] = []
        size = number = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            names = pa.concat_arrays([h[0] for h in held])
            counts = np.concatenate([h[1] for h in held])
            edges = pa.array([0, len(names)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(edges, names), pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64())),
                 pa.array([rans.encode(ids, table)], pa.binary())],
                names=["part", "block", "n_tokens", "doc_ids", "counts", "payload"])

        for batch in batches:
            flat, at = _unpacked(batch.column(1))
            k, n = 0, batch.num_rows
            while k < n:  # the rows from k on that bring the block to its size
                m = min(n, int(np.searchsorted(at, at[k] + block - size, side="left")))
                m = max(m, k + 1)
                held.append((batch.column(0).slice(k, m - k), np.diff(at[k:m + 1])))
                pieces.append(flat[at[k]:at[m]].astype(np.uint32))
                size += int(at[m] - at[k])
                k = m
                if size >= block:
                    yield close()
                    held, pieces, size, number = [], [], 0, number + 1
        if held:
            yield close()

    ordered.mapInArrow(work, f"part int, block int, n_tokens long, doc_ids array<{id_type}>, counts array<long>, payload binary"
                       ).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files; blocks decode apart."""
    with_python(spark)
    freq = bytes(spark.read.parquet(f"{path}/table").head().freq)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    base = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    offsets = blocks.select("part", "block", before.alias("before")).join(base, "part").select(
        "part", "block", (F.col("base") + F.col("before")).alias("first"))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(freq)
        for batch in batches:
            for k in range(batch.num_rows):
                flat = rans.decode(batch.column(4)[k].as_py(), table)
                docs = batch.column(2).slice(k, 1).flatten()
                counts = batch.column(3).slice(k, 1).flatten().to_numpy(zero_copy_only=False)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                raw = flat.astype("<u4").tobytes()
                n = len(docs)
                cols = [pa.array(np.full(n, batch.column(0)[k].as_py()), pa.int32()),
                        pa.array(np.full(n, batch.column(1)[k].as_py()), pa.int32()), docs, pa.array(at[:-1]),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.int64())]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    decoded = blocks.select("part", "block", "doc_ids", "counts", "payload").mapInArrow(
        work, f"part int, block int, doc_id {id_type}, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)
    return decoded.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * ids))
