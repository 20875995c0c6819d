"""Every query over odd rows against a plain Python version, and over no rows."""

import collections
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tramline.llm.catalog import QUERIES


def run(spark, name, folder):
    full = next(q for q in QUERIES if q.startswith(name + "_"))
    return QUERIES[full](spark, folder).collect()


def same(got, want):
    order = lambda x: tuple((v is not None, str(type(v)), v) for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_join(spark, odd_dir, rows):
    got = run(spark, "op1", odd_dir)
    same([(r.doc_id, r.class_id, r.n_links) for r in got], brute.jaccard_classes(rows))


def test_sharding(spark, odd_dir, rows):
    got = run(spark, "op2", odd_dir)
    size = lambda t: len((t or "").encode()) + 1
    same([(r.doc_id, r.size, r.text_crc32) for r in got], [(d, size(t), zlib.crc32((t or "").encode())) for d, t in rows])
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_decontamination(spark, odd_dir, rows, items):
    got = run(spark, "op3", odd_dir)
    want = brute.contamination(rows, items)
    assert sum(x[2] > 0 for x in want) > 4
    same([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got],
         [(d, n, h, len(i.split(",")) if i else 0, brute.sha(i), h > 0) for d, n, h, i in want])


def test_passages(spark, odd_dir, rows):
    got = run(spark, "op4", odd_dir)
    flagged = collections.Counter((r.doc_id, r.has_duplicate) for r in got)
    exact = brute.shared_passages(rows)
    assert len(got) == len(rows) and any(exact)
    for (doc_id, _), shared in zip(rows, exact, strict=True):
        if shared:
            assert flagged[doc_id, True]
    by_id = {r.doc_id: r for r in got}
    long, led = by_id[10_000 + 24], by_id[10_000 + 25]
    assert long.class_id == led.class_id == long.doc_id and (long.n_dup_words, led.spans) == (120, "2:122")


def test_licenses(spark, odd_dir, rows):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    want = []
    for doc_id, text in rows:
        w = brute.words(text)
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p]
        want.append((doc_id, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
                     ",".join(sorted({x for _, x in at}))))
    got = run(spark, "op5", odd_dir)
    same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], want)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


@pytest.mark.parametrize(("name", "patterns", "kinds"), [
    ("op6", brute.PII, ["email", "ip", "card", "phone"]), ("op7", brute.SECRETS, ["assign", "access", "hex"])])
def test_spans(spark, odd_dir, rows, name, patterns, kinds):
    got = run(spark, name, odd_dir)
    want = []
    for doc_id, text in rows:
        spans = brute.base_spans(text, patterns, kinds)
        want.append((doc_id, *(sum(s.startswith(k + ":") for s in spans.split(",")) for k in kinds), brute.sha(spans)))
    same([(r.doc_id, *(r[f"n_{k}"] for k in kinds), r.base_sha256) for r in got], want)
    by_hash = {brute.sha(s): s for _, t in rows for s in [brute.base_spans(t, patterns, kinds)]}
    for r in got:
        assert set(filter(None, by_hash[r.base_sha256].split(","))) <= set(r.spans.split(","))


def test_repetition(spark, odd_dir, rows):
    got = run(spark, "op8", odd_dir)
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_long_repeat_words, r.kept)
          for r in got], [(d, *brute.repetition(t)) for d, t in rows])


def test_packing(spark, odd_dir, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            want.append((doc_id, p, s, len(ids[s:s + 4096]), brute.crc_ids(ids[s:s + 4096])))
    got = run(spark, "op9", odd_dir)
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 4096


def test_token_files(spark, odd_dir, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(run(spark, "op10", odd_dir), key=lambda r: r.start)
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows]
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got],
         [(d, len(x), brute.crc_ids(x)) for (d, _), x in zip(rows, ids, strict=True)])
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in got[:len(got) - len(known)])
