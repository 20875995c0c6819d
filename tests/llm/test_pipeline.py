"""Each stage against a plain version on its own input, and run() end to end."""

import collections
import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tramline.llm.common import documents, settle


@pytest.fixture(scope="module")
def stages(spark, odd_dir):
    """The rows before the first stage and after each, as lists of dicts."""
    docs, out = documents(spark, odd_dir), {}
    out["input"] = [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, odd_dir)
        if name != "packing":
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        docs = settle(result, name)
        out[name] = [r.asDict() for r in docs.collect()]
    return out


def bag(rows):
    return collections.Counter(repr(sorted(r.items())) for r in rows)


def test_quality_rules(stages):
    assert bag(stages["quality_rules"]) == bag(r for r in stages["input"] if brute.repetition(r["text"])[-1])


def test_near_duplicates(stages):
    before, after = stages["quality_rules"], stages["near_duplicates"]
    assert not bag(after) - bag(before)
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, hashlib.md5(r["text"].encode()).hexdigest())
    # classes by position: ids need not be unique
    numbered = [(i, r["text"]) for i, r in enumerate(before)]
    classes = collections.defaultdict(list)
    for (i, _), (_, c, _) in zip(numbered, brute.jaccard_classes(numbered), strict=True):
        classes[c].append(before[i])
    want = sorted(key(min(c, key=key)) for c in classes.values())
    assert sorted(map(key, after)) == want and len(after) < len(before)


def test_decontamination(stages, items):
    before = stages["near_duplicates"]
    found = brute.contamination([(0, r["text"]) for r in before], items)
    assert bag(stages["decontamination"]) == bag(r for r, f in zip(before, found, strict=True) if not f[2])
    assert any(f[2] for f in found)


def test_secret_scans(stages):
    before = {(r["doc_id"], r["row"]): r for r in stages["decontamination"]}
    after = {(r["doc_id"], r["row"]): r for r in stages["secret_scans"]}
    assert before.keys() == after.keys()
    kinds = ["assign", "access", "hex"]
    for k, r in after.items():
        spans = brute.base_spans(before[k]["text"], brute.SECRETS, kinds)
        if spans:
            assert "[SECRET]" in r["text"] and not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r["text"])
            assert r["n_chars"] == len(r["text"])
        elif "[SECRET]" not in r["text"]:
            assert r == before[k]


def test_packing_and_run(spark, odd_dir, stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in stages["secret_scans"]:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            want[r["doc_id"], p, s, tuple(ids[s:s + 4096])] += 1
    pieces = lambda rows: collections.Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows)
    assert pieces(stages["packing"]) == want
    assert pieces(r.asDict() for r in corpus_pipeline.run(spark, odd_dir).collect()) == want


def test_no_rows(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
