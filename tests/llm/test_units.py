"""Parts of the operators by themselves."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tramline.llm import ngram_join, rans, substrings
from tramline.llm.chunks import ChunkTokenizer
from tramline.llm.components import components
from tramline.llm.packing import BestFit
from tramline.llm.spans import prefix_sums
from tramline.llm.words import row_slices, text_buffer


@pytest.mark.parametrize(("name", "folds"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_chunk_ids_equal_whole_texts(name, folds):
    t = ChunkTokenizer(public_tokenizers.path(name), folds)
    r = random.Random(5)
    letters = list(" \n\t'aAsStT129.,!<|>()-_é 　ñİß́Ωςc\x1c\x85\r\x0b日") + ["'s", "'re", "<|endoftext|>", "  ", "\n\n", " word"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3_000)]
    buf, off = text_buffer(pa.array(texts))
    counted = np.zeros(50_257, np.int64)
    got = []
    for i, j in row_slices(off, 5_000):
        part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        ids, edge = t.encode(part, at)
        counted += t.count(part, at, 50_257)
        got += [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:], strict=True)]
    assert got == [t.whole(x).tolist() for x in texts]
    assert (counted == np.bincount([i for x in got for i in x], minlength=50_257)).all()


@pytest.mark.parametrize("n", [0, 1, 7, 600, 5_000, 1_200_000])
def test_rans_round_trip_and_sections(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_257).astype(np.uint32)
    table = rans.make_table(rans.normalised(np.bincount(ids, minlength=50_257)))
    raw = rans.encode(ids, table)
    assert (rans.decode(raw, table) == ids).all()
    block = rans.parse(raw, table)
    parts = [block.section(k, table) for k in reversed(range(len(block.positions)))]
    assert (np.concatenate([np.zeros(0, np.uint32), *parts[::-1]]) == ids).all()
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(raw[:-1] + bytes([raw[-1] ^ 1]), table)


def test_best_fit_takes_the_fullest_bin_that_holds():
    p = BestFit(10, 2)
    assert [p.place(n) for n in (6, 7, 3, 4, 9, 9, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (3, 9)]
    assert p.place(5) == (4, 0) and p.place(5) == (4, 5)  # bin 2 is open with one place free


def test_bounded_bins_close_the_fullest():
    p = BestFit(10, 2)
    assert [p.place(n)[0] for n in (6, 8, 7, 2)] == [0, 1, 2, 2]  # bin 1, the fullest, closed for bin 2


def test_overlaps_and_first_common_leaf():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (ngram_join.overlaps(sets) == want).all()
    one = [np.arange(10, dtype=np.uint64)] * 3
    everyone, weight = np.ones(3, np.bool_), np.array([1, 1, 1])
    leaves = [np.array([1, 5]), np.array([1, 5]), np.array([5])]
    first, _ = ngram_join.compare_bucket(1, everyone, everyone, one, weight, leaves, 0.8)
    later, forest = ngram_join.compare_bucket(5, everyone, everyone, one, weight, leaves, 0.8)
    assert first.tolist() == [2, 2, 2] and later.tolist() == [1, 1, 2] and len(forest) == 2


def test_split_buckets_and_blocks_find_all_links(spark, monkeypatch):
    """Small limits, so that buckets are split again and alike ones compared block by block."""
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    r = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(12):
        common = [r.choice(vocabulary) for _ in range(60)]
        for k in range(20 if g < 2 else 3):
            w = list(common)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(60)] = r.choice(vocabulary)
            rows.append((100 * g + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.jaccard_classes(docs).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == sorted(brute.jaccard_classes(rows))


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (6, None)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 7: 7} | {i: 100 for i in range(100, 141)}


def test_compact_windows_are_the_cartesian_tree_nodes():
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefg") + r.choice("xyz") for _ in range(n)) for n in (0, 3, 12, 30, 80)]
    buf, off = text_buffer(pa.array(texts))
    w, grams = substrings._grams(buf, off)
    span = 8
    salts = iter(substrings._SALT)
    for value, row, left, right in substrings.compact_windows(w, grams, span):
        salt = next(salts)
        want = set()
        for k in range(len(texts)):
            a, b = w.first[k], w.first[k + 1] - substrings.N + 1
            v = substrings.mix(grams[a:max(a, b)] ^ salt)
            for i in range(len(v) - span + 1):
                m = v[i:i + span].min()
                lo, hi = i, i + span - 1
                while lo > 0 and v[lo - 1:hi + 1].min() == m and v[max(0, lo - 1):lo - 1 + span].min() == m:
                    lo -= 1
                while hi < len(v) - 1 and v[hi + 1 - span + 1:hi + 2].min() == m:
                    hi += 1
                want.add((k, lo, hi))
        assert set(zip(row.tolist(), left.tolist(), right.tolist(), strict=True)) == want


def test_prefix_sums(spark):
    rows = [([],), ([5],), (list(range(1, 1_300)),)]
    got = spark.createDataFrame(rows, "x array<int>").select("x", prefix_sums(F.col("x")).alias("s")).collect()
    assert all(r.s == np.cumsum(r.x).tolist() for r in got)
