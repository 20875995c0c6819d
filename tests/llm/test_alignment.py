"""Token alignment against whole-text encoding and plain loops."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.test_queries import run, same
from tramline.llm.alignment import Alignment, ByteTokenizer, PieceTokenizer, Side, align
from tramline.llm.chunks import _SYMBOL

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    value = {c: b for b, c in enumerate(_SYMBOL)}
    p = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def by_bytes(text):
        e = t.encode(text, add_special_tokens=False)
        return [(k, bytes(value[c] for c in s)) for k, s in zip(e.ids, e.tokens, strict=True)]

    def by_pieces(text):
        return [(k, bytes([int(s[3:5], 16)]) if p.is_byte(k) else s.replace("▁", " ").encode())
                for k, s in ((k, p.id_to_piece(k)) for k in p.encode(text))]

    return by_bytes, by_pieces


def test_alignment(spark, odd_dir, rows, encoders):
    got = run(spark, "op12", odd_dir)
    want = brute.alignment(rows, *encoders)
    assert len(got) == len(want) and any(w[3] > 50 for w in want)
    same([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in got], [w[:7] for w in want])
    digests = {(r.doc_id, r.n_a, r.groups_sha256) for r in got}
    assert all((w[0], w[1], w[7]) in digests for w in want if w[7] is not None)


def test_defined_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 7), (2, "", 7), (3, "a▁b", 7), (4, "<|endoftext|><s>", 7), (4, "same", 7), (4, "same", 7), (None, " ", 7), (5, "\n", 7)],
        "doc_id long, text string, n_a int")
    got = {(r.doc_id, r.n_a, r.n_links, r.groups_sha256) for r in align(docs, BYTES, PIECES).collect()}
    assert {(1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, "")} <= got
    assert all(n for d, n, _, _ in got if d not in (1, 2, 3)) and len(got) == 7


def test_shuffled_counts_agree(spark, odd_dir, monkeypatch):
    from tramline.llm import alignment, common
    want = sorted(map(repr, run(spark, "op12", odd_dir)))
    monkeypatch.setattr(alignment, "broadcast_if_small", lambda df: common.broadcast_if_small(df, 0))
    assert sorted(map(repr, run(spark, "op12", odd_dir))) == want


def test_chunked_pieces_are_whole_text_pieces():
    rng = random.Random(5)
    p = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    parts = [" ", "  ", "   ", "\n", "\t", "a", "word", "Ünï", " ", "　", "日本", "x" * 30, "<s>", "<0x41>", "\x00", "…", "1234", "don't", "\U0001F600", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(4_000)]
    enc = PieceTokenizer(PIECES)
    raw = [(" " + t).encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, at = enc.encode(buf, off)
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == p.encode(t), repr(t)


def test_long_text_many_matches(encoders):
    text = " ".join(f"tok{i % 977}en-{i}" for i in range(60_000))
    a, b = Side(ByteTokenizer(BYTES)), Side(PieceTokenizer(PIECES))
    raw = np.frombuffer(text.encode(), np.uint8)
    got = Alignment(raw, np.array([0, len(raw)]), a, b)
    assert got.n_groups[0] >= 60_000 and len(got.link_a) == len(got.a) + len(got.b) - int(
        np.isin(np.cumsum(a.length[got.a]) - a.length[got.a], np.cumsum(b.length[got.b]) - b.length[got.b]).sum())
