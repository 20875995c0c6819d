"""op4: passages that a list's least text, or other places of the same n-grams, could hide."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tramline.llm import substrings
from tramline.llm.substrings import alike, duplicate_passages
from tramline.llm.words import mix


def filler(r, n):
    return [f"f{r.getrandbits(40):x}" for _ in range(n)]


def late(spark, texts):
    """The text of greatest hash, which is no list's least one if others are there."""
    return spark.createDataFrame([(t,) for t in texts], "text string").orderBy(F.xxhash64("text").desc()).first().text


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in duplicate_passages(docs).collect()}


def test_frequent_ngrams_of_other_texts_hide_no_passage(spark):
    r = random.Random(5)
    passage = filler(r, 50)
    a, b = (late(spark, [" ".join(filler(r, 20) + passage + filler(r, 20)) for _ in range(300)]) for _ in range(2))
    others = [" ".join(filler(r, 45) + passage[k:k + 5] + filler(r, 45)) for k in range(46) for _ in range(12)]
    got = found(spark, [a, b, *others])
    for k in (0, 1):
        assert got[k].class_id == 0 and [tuple(s) for s in got[k].spans] == [(20, 70)] and got[k].n_links == 1
    assert sum(len(x.removable) for x in got.values()) == 1
    assert all(got[k].class_id == k and not got[k].spans for k in range(2, len(got)))


def hashes(words):
    return np.array([zlib.crc32(" ".join(words[k:k + 5]).encode()) for k in range(len(words) - 4)], np.uint32)


def test_every_occurrence_counts():
    r = random.Random(6)
    passage = filler(r, 50)
    twice, once = passage + filler(r, 30) + passage, filler(r, 7) + passage
    assert [m[:2] for m in alike(hashes(twice), hashes(once), 46, 0.8)] == [(0, 46), (80, 126)]
    assert [m[2:] for m in alike(hashes(once), hashes(twice), 46, 0.8)] == [(0, 46), (80, 126)]
    quoted = passage[20:45] + filler(r, 30) + passage
    assert alike(hashes(quoted), hashes(once), 46, 0.8) == [(55, 101, 7, 53)]
    changed = passage[:25] + filler(r, 1) + passage[26:]
    assert [m[:2] for m in alike(hashes(filler(r, 9) + changed), hashes(once), 46, 0.8)] == [(9, 55)]
    assert not alike(hashes(passage[:40] + filler(r, 30)), hashes(once), 46, 0.8)


def test_pairs_are_aligned_together(monkeypatch):
    r = random.Random(10)
    words = filler(r, 40)
    texts = []
    for _ in range(60):
        common = [r.choice(words) for _ in range(90)] if r.random() < 0.3 else filler(r, 90)
        for _ in range(2):
            t = [w if r.random() < 0.97 else f"x{r.getrandbits(40):x}" for w in common]
            texts.append(hashes(filler(r, r.randint(0, 9)) + t + common[:r.choice([0, 60])]))
    pairs = [(texts[k], texts[k ^ 1]) for k in range(len(texts))] + [(texts[0], texts[5]), (texts[1][:0], texts[1])]
    one_by_one = [alike(x, y, 46, 0.8) for x, y in pairs]
    assert sum(map(bool, one_by_one)) > 60 and not all(one_by_one)
    calls = []
    aligned = substrings._aligned
    monkeypatch.setattr(substrings, "_aligned", lambda *a: calls.append(1) or aligned(*a))
    assert substrings.alike_all(pairs, 46, 0.8) == one_by_one
    assert len(calls) <= 10  # array passes for all pairs, and not for each of them
    monkeypatch.setattr(substrings, "TOGETHER", 40000)
    monkeypatch.setattr(substrings, "HELD", 500)
    assert substrings.alike_all(pairs, 46, 0.8) == one_by_one


def test_many_repeats_are_met_in_parts(monkeypatch):
    monkeypatch.setattr(substrings, "MATCHES", 1000)
    monkeypatch.setattr(substrings, "PART", 60)
    r = random.Random(7)
    passage, line = filler(r, 60), filler(r, 4)
    x, y = line * 80 + passage + line * 80, filler(r, 300) + passage + line * 100
    got = alike(hashes(x), hashes(y), 46, 0.8)
    marked = {k for a, b, _, _ in got for k in range(a, b)}
    assert marked == set(range(len(x) - 4)) - set(range(316, 320))  # n-grams from the line into the passage
    assert {k for _, _, a, b in got for k in range(a, b)} == set(range(300, len(y) - 4))


def test_bands_of_repeats_that_add_nothing_are_left_out(monkeypatch):
    x, y = (np.tile(np.arange(3, dtype=np.uint32), n) for n in (300, 70))

    def united(spans):
        return {p for a, b in spans for p in range(a, b)}

    few = alike(x, y, 46, 0.8)
    monkeypatch.setattr(substrings, "SOON", 1 << 40)
    every = alike(x, y, 46, 0.8)
    assert len(few) * 4 < len(every)
    for side in (slice(0, 2), slice(2, 4)):
        assert united(m[side] for m in few) == united(m[side] for m in every)
    assert united(m[:2] for m in few) == set(range(len(x)))


def test_a_passage_twice_in_one_text(spark):
    r = random.Random(8)
    passage = filler(r, 50)
    got = found(spark, [" ".join(passage + filler(r, 30) + passage), " ".join(filler(r, 7) + passage),
                        " ".join(passage[20:45] + filler(r, 30) + passage)])
    assert [[tuple(s) for s in got[k].spans] for k in range(3)] == [[(0, 50), (80, 130)], [(7, 57)], [(55, 105)]]
    assert {got[k].class_id for k in range(3)} == {0}


def test_copies_are_passages_as_a_whole(spark):
    r = random.Random(9)
    long, short, near = (" ".join(filler(r, n)) for n in (120, 49, 60))
    texts = [long, short, long, near, short, long, "Été " + near, near, "", "", None, None]
    got = found(spark, texts)
    spans = {k: [tuple(s) for s in x.spans] for k, x in got.items()}
    assert [spans[k] for k in (0, 2, 5)] == [[(0, 120)]] * 3 and [got[k].n_dup_words for k in (0, 2, 5)] == [120] * 3
    assert [[tuple(s) for s in got[k].removable] for k in (0, 2, 5)] == [[], [(0, 120)], [(0, 120)]]
    assert spans[3] == spans[7] == [(0, 60)] and spans[6] == [(1, 61)] and [tuple(s) for s in got[7].removable] == [(0, 60)]
    assert not got[3].removable or not got[6].removable
    assert all(not got[k].spans and not got[k].removable for k in (1, 4, 8, 9, 10, 11))
    rows = spark.createDataFrame([(None, long), (None, long), (4, long), (4, long)], "doc_id long, text string")
    assert sorted((x.doc_id or 0, len(x.removable)) for x in duplicate_passages(rows).collect()) == [(0, 1), (0, 1), (4, 0), (4, 1)]


def test_n_links_counts_every_alike_text(spark, monkeypatch):
    """Also those over links that add no passage, in lists of any length, with words changed, put in or left out."""
    r = random.Random(13)
    common, quoted = filler(r, 150), filler(r, 60)
    texts = [filler(r, 20) + quoted + filler(r, r.randint(0, 9)) for _ in range(8)]
    for k in range(24):
        words = [w if r.random() < 0.99 else filler(r, 1)[0] for w in common]
        at = r.randrange(150)
        texts.append(words[:at] + (filler(r, 1) + words[at:] if k % 3 == 0 else words[at + (k % 3 == 1):]))
    texts += [filler(r, 90) for _ in range(3)]
    want = [sum(bool(alike(hashes(x), hashes(y), 46, 0.8)) for y in texts if y is not x) for x in texts]
    assert want[:8] == [7] * 8 and want[-3:] == [0] * 3 and min(want[8:-3]) > 10
    rows = [" ".join(t) for t in texts] * 2  # a copy is no other text
    for long, block in ((512, 2048), (4, 2048), (4, 10)):
        monkeypatch.setattr(substrings, "LINKED", long)
        monkeypatch.setattr(substrings, "BLOCK", block)
        got = found(spark, rows)
        assert [got[k].n_links for k in range(len(rows))] == want * 2


def test_pairs_of_a_list_are_linked_for_certain_only_if_alike():
    r = random.Random(14)
    some = 0
    for _ in range(30):
        own = r.randrange(1 << 64)
        value = int(mix(mix(np.array([own], np.uint64) ^ substrings._SALT[2]) + substrings._SALT[2]).view(np.int64)[0])
        common = [r.randrange(1 << 32) for _ in range(60)]
        common[30] = own >> 32
        grams = []
        for k in range(10):
            g = [x if i == 30 or r.random() < 0.93 else r.randrange(1 << 32) for i, x in enumerate(common)]
            if k % 3 == 0:
                g.insert(r.choice([12, 25]), r.randrange(1 << 32))
            grams.append(np.array(g[r.randint(0, 12):len(g) - r.randint(0, 12)], np.uint32))
        around = substrings._around(grams, value, 46)
        assert (around[:, 45] == own >> 32).all()
        pairs = np.array([(k, o) for k in range(10) for o in range(k)])
        certain = substrings._certain(around, pairs, 46, 41)
        likely = np.concatenate(list(substrings._likely(around, np.tril(np.ones((10, 10), np.bool_), -1), 46, 41)))
        assert {tuple(p) for p in pairs[certain].tolist()} <= {tuple(p) for p in likely.tolist()}
        same = [bool(alike(grams[k], grams[o], 46, 0.8)) for k, o in pairs.tolist()]
        assert all(s for s, c in zip(same, certain.tolist(), strict=True) if c)
        some += int(certain.sum())
        assert sum(same) - certain.sum() < 30
    assert some > 30


def test_texts_are_cut_into_windows_once_and_ngrams_go_to_cells_alone(spark, monkeypatch):
    written = {}

    def settle(df, name, write=substrings.settle):
        written[name] = df.columns
        return write(df, name)

    monkeypatch.setattr(substrings, "settle", settle)
    cut = spark.sparkContext.accumulator(0)

    def windows(docs, passage, made=substrings.windows):
        def seen(batches):
            for batch in batches:
                cut.add(batch.num_rows)
                yield batch

        return made(docs.mapInArrow(seen, docs.schema), passage)

    monkeypatch.setattr(substrings, "windows", windows)
    r = random.Random(15)
    passage = filler(r, 60)
    read = [" ".join(filler(r, 9) + passage + filler(r, k)) for k in range(12)]
    got = found(spark, read)
    assert {x.n_links for x in got.values()} == {11}
    assert cut.value == len(read)
    assert "grams" in written["contents"] and "grams" not in written["windows"]
