"""The pairs of a list that op4 verifies against a pair by pair search, and op1's united buckets."""

from __future__ import annotations

import random

import numpy as np

from tramline.llm import common, ngram_join, substrings


def _by_pairs(items, grams, late, whole, least):
    out = []
    for k, t in enumerate(items):
        for o, u in enumerate(items):
            mine, theirs = set(grams[k].tolist()), set(grams[o].tolist())
            fit = (u["node"] < t["node"] and sum(g in theirs for g in grams[k].tolist()) >= least
                   and sum(g in mine for g in grams[o].tolist()) >= least)
            if len({x["block"] for x in items}) > 1:
                fit = fit and t["block"] != u["block"]
            adds = (set(grams[k][late[k]].tolist()) & theirs or set(grams[o][whole[o]].tolist()) & mine
                    or t["label"] != u["label"])
            if fit and adds:
                out.append([k, o])
    return out


def test_candidates_are_those_of_a_search_of_all_pairs():
    r = random.Random(5)
    some = 0
    for trial in range(60):
        common = [r.randrange(1 << 32) for _ in range(30)]
        items, grams = [], []
        for k in range(r.randint(2, 14)):
            g = [x if r.random() < 0.85 else r.randrange(1 << 32) for x in common]
            g += [r.choice(common) for _ in range(r.randint(0, 4))]
            spans = [{"start": a, "end": a + r.randint(5, 34)} for a in sorted(r.sample(range(10), r.randint(0, 2)))]
            items.append({"node": r.randrange(9), "l": r.randint(0, 3), "label": r.choice([1, 1, 1, trial % 2]),
                          "block": r.choice([0, trial % 3 // 2]), "spans": spans or None, "late": spans[:1]})
            grams.append(np.array(g, np.uint32))
        late, whole = (substrings._uncovered(items, grams, c) for c in ("late", "spans"))
        got = substrings._candidates(items, grams, late, whole, 20).tolist()
        assert got == _by_pairs(items, grams, late, whole, 20)
        some += len(got)
    assert some > 100


def test_windows_in_known_passages_of_one_class_need_no_pairs():
    grams = [np.arange(50, dtype=np.uint32)] * 3
    items = [{"node": k, "l": 0, "label": 1, "block": 0, "spans": [{"start": 0, "end": 60}], "late": [{"start": 0, "end": 60}]}
             for k in range(3)]
    flags = substrings._uncovered(items, grams, "spans")
    assert len(substrings._candidates(items, grams, flags, flags, 41)) == 0


def test_rare_and_frequent_ngrams_are_counted_alike(monkeypatch):
    rng = np.random.default_rng(4)
    grams = [np.append(rng.integers(0, 400, 60), [1000, 1001]).astype(np.uint32) for _ in range(40)]
    grams += [np.roll(g, 3) for g in grams[:10]]
    items = [{"node": int(k), "label": int(k) % 3, "block": 0} for k in rng.permutation(len(grams))]
    flags = [[rng.random(len(g)) < 0.02 for g in grams] for _ in range(2)]
    got = []
    for dense in (0, 10, 1 << 20):  # pairs only, both, matrix products only
        monkeypatch.setattr(substrings, "DENSE", dense)
        monkeypatch.setattr(substrings, "HELD", 100)
        got.append(substrings._candidates(items, grams, *flags, 12).tolist())
    assert got[0] and got[0] == got[1] == got[2]


def test_alike_buckets_are_one(spark, monkeypatch):
    """A group of near copies fills a bucket at every position, and is compared as one bucket."""
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    r = random.Random(2)
    common = [r.randrange(1 << 30) for _ in range(ngram_join.POSITIONS)]
    rows = [(k.to_bytes(16, "big"), [t if r.random() < 0.95 else r.randrange(1 << 30) for t in common]) for k in range(200)]
    rows += [((1000 + k).to_bytes(16, "big"), [r.randrange(1 << 30) for _ in common]) for k in range(400)]
    nodes = spark.createDataFrame(rows, "node binary, tokens array<int>")
    leaves = ngram_join.leaf_buckets(nodes, 0.8, 0.99999).collect()
    group = [x for x in leaves if int.from_bytes(x.node, "big") < 200]
    assert len(group) <= 2 * 200
    assert max(x.n for x in group) == len({x.node for x in group}) == 200


def test_members_of_large_buckets_are_met_once(spark, monkeypatch):
    """Whether a bucket is split, united or left is found from buckets alone; its members are then read once."""
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    met = []

    def settle(df, name, write=ngram_join.settle):
        out = write(df, name)
        if {"node", "path"} <= set(df.columns):
            met.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "settle", settle)
    r = random.Random(4)
    common = [r.randrange(1 << 30) for _ in range(ngram_join.POSITIONS)]
    rows = [(k.to_bytes(16, "big"), [t if r.random() < 0.97 else r.randrange(1 << 30) for t in common]) for k in range(300)]
    leaves, _ = ngram_join._paths(spark.createDataFrame(rows, "node binary, tokens array<int>"), 0, 3, 300)
    assert any(x.count() for x in leaves)
    starts = met.pop(0)[1]
    assert starts == 300 * 9 and sum(n for _, n in met) <= starts


def test_tables_of_few_rows_are_few_files(spark, monkeypatch):
    written = {}

    def settle(df, name, write=ngram_join.settle):
        out = write(df, name)
        written.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "settle", settle)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "111")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        r = random.Random(6)
        rows = [(k, " ".join(str(r.randrange(9)) for _ in range(9))) for k in range(400)]
        ngram_join.jaccard_classes(spark.createDataFrame(rows + rows[:9], "doc_id long, text string")).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    files = common.files_for(spark, 400)
    assert files < 111 and all(max(written[k]) <= files for k in ("starts", "buckets", "fates", "kept", "met", "leaves")), written
    assert common.files_for(spark, 1_000 * common.FILE_ROWS) > 1_000


def test_a_pair_is_verified_in_one_list_and_not_in_each(spark, monkeypatch):
    rests = []

    def settle(df, name, write=substrings.settle):
        out = write(df, name)
        if name == "rest":
            rests.append(out.select("node", "other").collect())
        return out

    monkeypatch.setattr(substrings, "settle", settle)
    r = random.Random(8)
    word = lambda: f"f{r.getrandbits(40):x}"
    common = [word() for _ in range(400)]
    texts = [" ".join(w if r.random() < 0.98 else word() for w in common) for _ in range(25)]
    got = substrings.duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x.class_id for x in got} == {0}
    assert len(rests[0]) > 40 and len(set(rests[0])) == len(rests[0])


def test_texts_are_stitched_from_their_windows():
    g = np.arange(1000, 1300, dtype=np.uint32)
    windows = [(200, g[200:250]), (10, g[10:60]), (40, g[40:100]), (45, g[45:50]), (103, g[103:120])]
    grams, places = substrings._stitched(windows, 46, 7)
    inside = [*range(10, 100), *range(100, 103), *range(103, 120), *range(120, 166), *range(200, 250)]
    assert places.tolist() == inside
    assert grams.tolist() == [7 if 100 <= p < 103 or 120 <= p < 166 else 1000 + p for p in inside]


def test_windows_that_share_little_more_than_their_list_are_left_out(spark):
    r = random.Random(3)
    passage = [r.randrange(1 << 31) for _ in range(60)]
    rows = []
    for k in range(40):
        g = [5] + (passage[:r.randint(30, 60)] if k % 4 == 0 else []) + [r.randrange(1 << 31) for _ in range(50)]
        rows.append((k % 2, k, 3, np.array(g, np.int32).tobytes()))
    got = {x.node for x in substrings._partnered(
        spark.createDataFrame(rows, "value long, node long, l int, grams binary"), 46, 0.8).collect()}
    grams = {k: (v, np.frombuffer(g, np.int32).tolist()) for v, k, _, g in rows}
    want = set()
    for k, (v, mine) in grams.items():
        others = {x for o, (u, theirs) in grams.items() if u == v and o != k for x in theirs}
        if sum(x in others for x in mine) >= 41:
            want.add(k)
    assert got == want and 3 < len(want) <= 10


def test_a_group_of_near_texts_needs_few_links(monkeypatch):
    """What one partner of each text finds is known before the next partners are looked at."""
    r = random.Random(11)
    common = [r.randrange(1 << 32) for _ in range(300)]
    items = []
    for k in range(120):
        g = [x if r.random() < 0.98 else r.randrange(1 << 32) for x in common]
        items.append({"value": 1, "node": k, "l": 0, "label": 0, "block": 0, "spans": None, "late": None,
                      "grams": np.array(g, np.uint32).tobytes()})
    links = list(substrings._Turn([items], 46, 0.8).links())
    assert len(links) < 10 * len(items)  # 7,140 pairs are alike
    marked = {k: set() for k in range(120)}
    for node, other, mine, theirs in links:
        for k, spans in ((node, mine), (other, theirs)):
            marked[k] |= {p for s in spans for p in range(s["start"], s["end"])}
    assert all(len(v) > 270 for v in marked.values())


def test_pairs_that_add_are_those_of_a_search_of_all_stretches():
    r = random.Random(12)
    some = 0
    for _ in range(40):
        common = [r.randrange(1 << 32) for _ in range(40)]
        grams = [np.array([x if r.random() < 0.9 else r.randrange(1 << 32) for x in common[r.randint(0, 9):]]
                          + [r.choice(common) for _ in range(r.randint(0, 9))], np.uint32) for _ in range(8)]
        late, whole = ([np.array([r.random() < 0.01 for _ in g]) for g in grams] for _ in range(2))
        pairs = np.array([(k, o) for k in range(8) for o in range(k)])
        want = []
        for k, o in pairs.tolist():
            sides = ((grams[k], set(grams[o].tolist()), late[k]), (grams[o], set(grams[k].tolist()), whole[o]))
            want.append(any(f[a:a + 12].any() and sum(x in theirs for x in g[a:a + 12].tolist()) >= 10
                            for g, theirs, f in sides for a in range(len(g) - 11)))
        got = substrings._adding(pairs, substrings._columns(grams), late, whole, 12, 10)
        assert got.tolist() == want
        some += sum(want)
    assert 100 < some < 1000
