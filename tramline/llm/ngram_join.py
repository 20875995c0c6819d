"""Similarity self-join of texts on word n-gram sets, by chosen paths.

Texts with the same n-gram set form one node; nodes are joined, copies follow
their node. A run of the join starts with all nodes in one bucket and splits
a bucket by the min-hash token that its members show at a few sampled
positions: members that share the token meet in a child bucket. Small buckets
are compared in full; larger ones are split again, at positions not used yet,
until they are small or stop shrinking (their members then are alike, and
blocks of them are compared in full, spread over tasks). Runs are repeated
until the chance to miss a pair at the threshold is below ``1 - recall``.

A pair may meet in several buckets. Each node carries the ids of its leaf
buckets, and a pair counts only in the first leaf that both share, so link
counts are exact without listing pairs. Before n-gram sets are fetched, the
signatures alone thin out buckets: a member stays where some partner that it
first meets there agrees in enough positions. What leaves a bucket is a count per
member and a spanning forest of its links: output grows with members, not
pairs.

Defined cases: words are runs of digits, ASCII letters (case folded) and
characters beyond ASCII. A text of fewer than n words is one n-gram of all its
words. A text without words (or null) has no links and is a class of its own.
Exact copies and repeated rows count as links of each other. A null doc_id is
allowed; a class is named by its least id that is not null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, files_for, settle, with_python
from tramline.llm.components import components
from tramline.llm.words import (LOWER, WORD_BYTES, ngram_hashes, row_slices, run_hashes, runs,
                                text_buffer)

#: Min-hash positions of a node's signature; a power of two, so that odd strides visit each once.
POSITIONS = 32
#: Sampled positions by which a bucket is split.
BRANCHES = 3
#: Members of a bucket that is compared in one piece; larger alike buckets are compared block by block.
LEAF = 1024
#: A large bucket that keeps this share of its parent's members is alike and not split further.
ALIKE = 0.5
#: Least member hashes by which large buckets are found to be alike.
SKETCH = 8
SEED = 17

_MULT = np.random.default_rng(SEED).integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngram_sets(buf: np.ndarray, off: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    low = LOWER[buf]
    w = runs(low, off, WORD_BYTES)
    wh = run_hashes(low, w.start, w.end)
    grams = ngram_hashes(wh, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(ngram_hashes(wh[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """POSITIONS min-hash tokens (uint32) for each set that is not empty."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((len(sets), POSITIONS), np.uint32)
    with np.errstate(over="ignore"):
        for j, a in enumerate(_MULT):
            out[:, j] = np.minimum.reduceat((flat * a) >> np.uint64(32), at)
    return out


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sign(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_key, node, tokens) of every row; node and tokens are null without words."""
    with_python(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for i, j in row_slices(off):
                sets = ngram_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], n)
                full = [k for k, s in enumerate(sets) if len(s)]
                node: list[bytes | None] = [None] * len(sets)
                tokens: list[np.ndarray | None] = [None] * len(sets)
                if full:
                    sig = signatures([sets[k] for k in full]).view(np.int32)
                    for k, row in zip(full, sig, strict=True):
                        node[k], tokens[k] = _set_key(sets[k]), row
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.array(node, pa.binary()), pa.array(tokens, pa.list_(pa.int32()))],
                    names=["doc_id", "text_key", "node", "tokens"])

    return docs.select("doc_id", "text", F.md5("text").alias("text_key")).mapInArrow(
        work, f"doc_id {id_type}, text_key string, node binary, tokens array<int>")


def sets_of(docs: DataFrame, n: int) -> DataFrame:
    """(node, grams): the n-gram set of every row with words, as packed 64-bit hashes."""
    with_python(docs.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            for i, j in row_slices(off):
                sets = [s for s in ngram_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], n) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_key(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "grams"])

    return docs.select("text").mapInArrow(work, "node binary, grams binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections (float32 matrix), a few thousand n-grams at a time."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    total = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((m, width), np.float32)
        dense[owner[a:b], column[a:b] - lo] = 1
        total += dense @ dense.T
    return total


def sketch_least(threshold: float, miss: float = 1e-6) -> int:
    """Positions in which a pair at the threshold agrees but for a chance of ``miss``."""
    below = 0.0
    for k in range(POSITIONS + 1):
        below += math.comb(POSITIONS, k) * threshold ** k * (1 - threshold) ** (POSITIONS - k)
        if below > miss:
            return k
    return POSITIONS


def _only_first_leaf(linked: np.ndarray, path: int, leaves: list[np.ndarray]) -> None:
    """Take pairs out that share a leaf before ``path``."""
    earlier: dict[int, list[int]] = {}
    for k, own in enumerate(leaves):
        for leaf in own[own < path].tolist():
            earlier.setdefault(leaf, []).append(k)
    for members in earlier.values():
        if len(members) > 1:
            linked[np.ix_(members, members)] = False


def likely(path: int, left: np.ndarray, right: np.ndarray, tokens: np.ndarray, leaves: list[np.ndarray], least: int) -> np.ndarray:
    """Flags of members with a partner whose signature agrees in ``least`` positions, and which they first meet here."""
    same = np.zeros((len(tokens), len(tokens)), np.int8)
    for column in tokens.T:
        same += column[:, None] == column[None, :]
    linked = same >= least
    linked &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    linked[np.arange(len(tokens)), np.arange(len(tokens))] = False
    _only_first_leaf(linked, path, leaves)
    return linked.any(axis=1)


def compare_bucket(path: int, left: np.ndarray, right: np.ndarray, sets: list[np.ndarray], weight: np.ndarray,
                   leaves: list[np.ndarray], threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links per member and a spanning forest, among members flagged left against those flagged right.

    Only pairs whose first common leaf is ``path`` count.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    inter = overlaps(sets).astype(np.float64)
    linked = inter >= threshold * (sizes[:, None] + sizes[None, :] - inter) - 1e-9
    linked &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    linked[np.arange(m), np.arange(m)] = False
    forest, seen = [], np.zeros(m, np.bool_)
    for root in range(m):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack:
            fresh = np.flatnonzero(linked[stack.pop()] & ~seen)
            seen[fresh] = True
            forest += [(root, int(k)) for k in fresh]
            stack += fresh.tolist()
    _only_first_leaf(linked, path, leaves)
    return linked @ weight, forest


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Rows of one (path, block pair) at a time, from sorted batches."""
    held: dict[str, list] = {}
    key = None
    for batch in batches:
        rows = batch.to_pydict()
        keys = list(zip(rows["path"], rows["low"], rows["high"], strict=True))
        i = 0
        while i < len(keys):
            j = i + 1
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
            if keys[i] != key:
                if held:
                    yield held
                held, key = {c: [] for c in rows}, keys[i]
            for c in rows:
                held[c] += rows[c][i:j]
            i = j
    if held:
        yield held


def _run_starts(first: int, count: int) -> list[tuple[int, int]]:
    """(run, position) pairs by which each run splits the root; runs use different positions first."""
    order = np.random.default_rng(SEED + 1).permutation(POSITIONS)
    return [(r, int(order[(r * BRANCHES + b) % POSITIONS])) for r in range(first, first + count)
            for b in range(BRANCHES)]


def runs_needed(threshold: float, recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with probability 1 - recall at most."""
    one = (1 - (1 - threshold) ** BRANCHES) ** depth
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - one)))


def _sketch() -> list[Column]:
    """Least hashes of a bucket's members; two buckets agree in one as often as their members are the same."""
    return [F.min(F.hash("node", F.lit(k))).alias(f"least_{k}") for k in range(SKETCH)]


def _alike(large: DataFrame, files: int) -> DataFrame:
    """(path, into): large buckets (path, n, least_...) that mostly hold the members of another one, which they may join.

    Members that meet at several positions are alike, and splitting their
    buckets would only repeat them. Every least hash of a bucket's members
    names the largest bucket that has it too; a bucket goes into the one that
    ``ALIKE`` of its hashes name, if that is not over twice its size. So
    members need not be met to find this.
    """
    held = large.select("path", "n", F.explode(F.array(*[F.xxhash64(F.lit(k), f"least_{k}") for k in range(SKETCH)])).alias("least"))
    best = held.groupBy("least").agg(F.max(F.struct("n", "path")).alias("best"))
    votes = held.join(best, "least").groupBy("path", "n", "best").agg(F.count("*").alias("votes"))
    voted = votes.groupBy("path", "n").agg(F.max(F.struct("votes", "best")).alias("v")).select(
        "path", F.when((F.col("v.votes") >= ALIKE * SKETCH) & (F.col("n") >= ALIKE * F.col("v.best.n")),
                       F.col("v.best.path")).otherwise(F.col("path")).alias("into"))
    voted = settle(voted.coalesce(files), "voted")
    onward = voted.select(F.col("path").alias("into"), F.col("into").alias("onward"))
    voted = voted.join(onward, "into").select("path", F.col("onward").alias("into"))
    several = voted.groupBy("into").agg(F.count("*").alias("parts")).filter("parts > 1")
    return settle(voted.join(several, "into").select("path", "into").coalesce(files), "alike")


def _bit(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), j.cast("int"))


def _paths(nodes: DataFrame, first_run: int, n_runs: int, total: int) -> tuple[list[DataFrame], int]:
    """Leaf buckets (path, node, n) of some runs and the depth they reached."""
    starts = F.array(*[F.struct(F.xxhash64(F.lit(r), F.lit(j), F.element_at("tokens", j + 1)).alias("path"),
                                F.lit(1 << j).cast("long").alias("used")) for r, j in _run_starts(first_run, n_runs)])
    files = files_for(nodes.sparkSession, total)
    rows = settle(nodes.select("node", F.explode(starts).alias("c")).select(
        "node", "c.path", "c.used", F.lit(total).cast("long").alias("above")).coalesce(files), "starts")
    leaves, depth = [], 1
    while True:
        stats = settle(rows.groupBy("path").agg(
            F.count("*").alias("n"), F.first("above").alias("above"), F.first("used").alias("used"),
            F.bit_xor(F.xxhash64("node")).alias("mark"), *_sketch()).filter("n > 1").coalesce(files), "buckets")
        stats = stats.join(broadcast_if_small(_alike(stats.filter(F.col("n") > LEAF), files)), "path", "left")
        split = (F.col("n") > LEAF) & (F.col("n") < ALIKE * F.col("above"))
        fate = F.when(F.col("into").isNotNull(), "unite").when(split, "split").otherwise("end")
        fates = settle(stats.select("path", "n", "used", "mark", "into", fate.alias("fate")).coalesce(files), "fates")
        # the same members meet again in other runs; one bucket of them is enough
        ends = fates.filter("fate = 'end'").groupBy("n", "mark").agg(F.min("path").alias("path"))
        kept = settle(fates.filter("fate <> 'end'").select("path", "n", "used", "into", "fate").union(ends.select(
            "path", "n", F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit("end"))).coalesce(files), "kept")
        # one join tells every member what becomes of its bucket
        met = settle(rows.select("path", "node").join(broadcast_if_small(kept), "path").coalesce(files), "met")
        leaves.append(met.filter("fate = 'end'").select("path", "node", "n"))
        united = met.filter("fate = 'unite'").select(F.col("into").alias("path"), "node").distinct()
        leaves.append(united.join(united.groupBy("path").agg(F.count("*").alias("n")), "path").select("path", "node", "n"))
        more = met.filter("fate = 'split'")
        if not more.limit(1).count():
            return leaves, depth
        if depth >= POSITIONS // BRANCHES:
            return [*leaves, more.select("path", "node", "n")], depth
        depth += 1
        start, stride = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(POSITIONS)), F.pmod(
            F.xxhash64("path", F.lit(2)), F.lit(POSITIONS // 2)) * 2 + 1
        free = F.slice(F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: F.pmod(start + i * stride, F.lit(POSITIONS))),
            lambda j: F.expr("used").bitwiseAND(_bit(j)) == 0), 1, BRANCHES)
        j = F.col("j")
        rows = settle(more.join(nodes.select("node", "tokens"), "node").withColumn("j", F.explode(free)).select(
            "node", F.xxhash64("path", j, F.element_at("tokens", (j + 1).cast("int"))).alias("path"),
            F.col("used").bitwiseOR(_bit(j)).alias("used"), F.col("n").alias("above")).coalesce(files), "paths")


def leaf_buckets(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(path, node, n) of all leaf buckets of as many runs as the recall asks for."""
    total = nodes.count()
    done = runs_needed(threshold, recall, 1)
    leaves, depth = _paths(nodes, 0, done, total)
    while (need := runs_needed(threshold, recall, depth)) > done:
        more, deeper = _paths(nodes, done, need - done, total)
        leaves, depth, done = leaves + more, max(depth, deeper), need
    out = leaves[0]
    for x in leaves[1:]:
        out = out.union(x)
    return settle(out.coalesce(files_for(nodes.sparkSession, total)), "leaves")


def _members(leaves: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(path, low, high, block, node): members of block pairs that a signature partner asks to compare.

    Large alike buckets are dealt out as pairs of blocks. A pair below the
    sketch's bound is at the threshold with a chance of one in a million.
    """
    last = F.floor((F.col("n") - 1) / LEAF).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(3)), last + 1).cast("int")
    least = sketch_least(threshold)
    of_node = leaves.groupBy("node").agg(F.collect_list("path").alias("leaves"))
    pairs = (leaves.withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
             .select("path", "node", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high")))
    known = nodes.select("node", "tokens").join(of_node, "node")
    rows = pairs.join(known, "node").repartition("path", "low", "high").sortWithinPartitions("path", "low", "high")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches):
            at = np.array(b["block"])
            keep = np.flatnonzero(likely(b["path"][0], at == b["low"][0], at == b["high"][0], np.array(b["tokens"], np.int32),
                                         [np.array(x, np.int64) for x in b["leaves"]], least))
            if len(keep):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b[c][k] for k in keep], t) for c, t in (
                        ("path", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("block", pa.int32()),
                        ("node", pa.binary()), ("leaves", pa.list_(pa.int64())))],
                    names=["path", "low", "high", "block", "node", "leaves"])

    return rows.mapInArrow(work, "path long, low int, high int, block int, node binary, leaves array<long>")


def _compare(members: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, links, other): link counts per block pair and member, and forest links, of all block pairs."""
    known = nodes.select("node", "copies").join(sets, "node")
    rows = members.join(known, "node").repartition("path", "low", "high").sortWithinPartitions("path", "low", "high")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches):
            at = np.array(b["block"])
            count, forest = compare_bucket(
                b["path"][0], at == b["low"][0], at == b["high"][0], [np.frombuffer(g, np.uint64) for g in b["grams"]],
                np.array(b["copies"], np.int64), [np.array(x, np.int64) for x in b["leaves"]], threshold)
            some = np.flatnonzero(count)
            node = [b["node"][k] for k in some] + [b["node"][k] for _, k in forest]
            if node:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.binary()), pa.array([*count[some].tolist(), *[0] * len(forest)], pa.int64()),
                     pa.array([*[None] * len(some), *(b["node"][r] for r, _ in forest)], pa.binary())],
                    names=["node", "links", "other"])

    return rows.mapInArrow(work, "node binary, links long, other binary")


def jaccard_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, class_id, n_links, n_copies, label).

    ``n_links`` counts the other rows whose n-gram sets have a Jaccard
    similarity of ``threshold`` or more, copies included; ``class_id`` is the
    least doc_id of all rows reached over links; ``n_copies`` the rows with
    the same set, this one included; ``label`` the class as a key that is there
    without ids as well, null for a text without words.
    """
    signed = settle(sign(docs, n), "signed")
    nodes = settle(signed.filter("node is not null").groupBy("node").agg(
        F.first("tokens").alias("tokens"), F.count("*").alias("copies"), F.min("doc_id").alias("least")), "nodes")
    members = settle(_members(leaf_buckets(nodes, threshold, recall), nodes, threshold), "members")
    wanted = members.select("node").distinct().join(nodes, "node").select(F.col("least").alias("id")).distinct()
    wanted = broadcast_if_small(settle(wanted, "wanted"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = sets_of(texts, n).groupBy("node").agg(F.first("grams").alias("grams"))
    found = settle(_compare(members, nodes, sets, threshold), "found")
    label = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = (nodes.select("node", "copies", "least").join(links, "node", "left").join(label, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    named = per_node.groupBy("label").agg(F.min("least").alias("class_id"))
    per_node = settle(per_node.join(named, "label").select(
        "node", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "class_id",
        "label"), "classes")
    wordless = F.col("node").isNull()
    return signed.select("doc_id", "text_key", "node").join(per_node, "node", "left").select(
        "doc_id", "text_key", F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), "label")


def keep_one_per_class(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row with the least doc_id stays.

    A null id comes before others. Ties on the id go to the least digest of the
    text; of rows equal in both, one stays. Rows without words all stay.
    """
    classes = settle(jaccard_classes(docs, n, threshold, recall).filter("label is not null").groupBy(
        "label", "doc_id", "text_key").agg(F.count("*").alias("rows")), "members")
    best = classes.groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("best"))
    marks = classes.join(best, "label").select(
        F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"),
        F.when(F.struct("doc_id", "text_key") != F.col("best"), "drop").when(F.col("rows") > 1, "repeated").alias("mark"))
    marks = broadcast_if_small(settle(marks.filter("mark is not null"), "marks"))
    row = F.struct("*")
    marked = docs.select(row.alias("row"), F.md5("text").alias("key")).join(
        marks, F.col("row.doc_id").eqNullSafe(F.col("m_id")) & (F.col("key") == F.col("m_key")), "left")
    once = marked.filter("mark = 'repeated'").groupBy("m_id", "m_key").agg(F.first("row").alias("row"))
    return marked.filter("mark is null").select("row.*").union(once.select("row.*"))
