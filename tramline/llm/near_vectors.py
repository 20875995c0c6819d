"""Near duplicates among embeddings by NN-descent.

Equal vectors become one node. A neighbour graph starts from buckets of
sampled rotations (a vector's bucket is the axis nearest to it) and is refined
by neighbours-of-neighbours joins: each node's list, the lists it stands in
and itself meet in one group, all pairs of the group are compared, and lists
keep their best. Only groups with a new edge meet again. A list whose entries
are all links is saturated and may grow to twice its length in the next round.
Lists leave out what is farther than twice the link angle: two links cannot
lead there. Vectors travel as one byte a dimension; the edges near the
threshold are then verified in double precision.

Lists are bounded, links are not: the links found connect components, and
``vector_counts`` counts all links inside each component exactly, through
blocks of nodes. The result is audited: sampled nodes are compared with all
nodes, and while they have found too few of their links, as many tables of
buckets again are added to the graph and it is refined anew.

Hot buckets are dealt out at random as several ones of a bounded size, hot
components as cells (see ``vector_counts``), and lists of a node that stands in
very many lists are cut in two steps, so no group is handled by one task.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
entries links with nothing: no links, its own component, kept. Vectors of
different lengths do not link. Repeated rows are other rows, linked at cosine
one. A component whose ids are all null has a null component_id, and its rows
count as kept. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, settle, with_python
from tramline.llm.components import components

LEAST_COSINE = 0.9
#: List length, and the most a saturated list grows to.
LIST, LONGEST = 8, 32
#: Nodes a bucket is made for, and the most that are compared in one piece.
BUCKET, BLOCK = 256, 1024
#: Chance to miss a pair at the threshold in all bucket tables of the first round.
MISS = 1e-3
#: A round that adds fewer edges than this share is the last; at most so many rounds.
QUIET, MOST_ROUNDS = 0.002, 6
#: Nodes that are audited against all nodes, the recall asked for, and how often tables may be added.
AUDITED, RECALL, MOST_AUDITS = 1024, 0.995, 6
#: Byte vectors give cosines with an error well below this.
ROUNDING = 0.015
#: Lists of one node are cut in this many pieces first.
PIECES = 16
SEED = 20240611


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows of one key at a time, as pieces of batches; the first ``keys`` columns are the (whole-number) key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, np.bool_)
        for c in columns:
            change |= c[1:] != c[:-1]
        for a, b in itertools.pairwise([0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield held
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def numbers(pieces: list[pa.RecordBatch], k: int) -> np.ndarray:
    return np.concatenate([p.column(k).to_numpy(zero_copy_only=False) for p in pieces])


def matrix(pieces: list[pa.RecordBatch], k: int) -> np.ndarray:
    """A list column of equal lengths as the rows of a matrix."""
    n = sum(p.num_rows for p in pieces)
    return np.concatenate([p.column(k).flatten().to_numpy(zero_copy_only=False) for p in pieces]).reshape(n, -1)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda c: c != 0), F.lit(False))


def _nodes(valid: DataFrame) -> DataFrame:
    """(node, d, v, copies, least, q): one row per distinct vector; q is the unit vector in bytes."""
    grouped = valid.groupBy("v").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
    rows = grouped.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("d"), "v", "copies", "least")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column(1).to_numpy()
            q: list[np.ndarray] = [np.zeros(0, np.int8)] * len(d)
            for k in np.unique(d).tolist():
                some = np.flatnonzero(d == k)
                u = unit(matrix([batch.take(pa.array(some))], 2))
                u = np.rint(127 * u / np.abs(u).max(axis=1, keepdims=True)).astype(np.int8)
                for i, row in zip(some.tolist(), u, strict=True):
                    q[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(q, pa.list_(pa.int8()))], names=[*batch.schema.names, "q"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return settle(rows.mapInArrow(work, ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", q array<tinyint>"), "nodes")


# --- bucket tables -----------------------------------------------------------


def levels(n: int, d: int) -> list[int]:
    """How many rotated axes each step of a bucket code looks at, for buckets of about BUCKET nodes."""
    out, wanted = [], n / BUCKET
    while wanted > 1:
        out.append(min(d, math.ceil(wanted / 2)))
        wanted /= 2 * out[-1]
    return out


def meeting_chance(n: int, d: int, cosine: float) -> float:
    """Chance that two vectors at ``cosine`` share a bucket of one table, from a fixed simulation."""
    rng, p = np.random.default_rng(SEED), 1.0
    for m in levels(n, d):
        x = rng.standard_normal((4000, m))
        y = cosine * x + math.sqrt(1 - cosine ** 2) * rng.standard_normal((4000, m))
        i, j = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1)
        rows = np.arange(4000)
        p *= float(((i == j) & (x[rows, i] * y[rows, j] > 0)).mean())
    return p


def tables_needed(n: int, d: int, cosine: float) -> int:
    p = meeting_chance(n, d, cosine)
    return 1 if p > 1 - MISS else math.ceil(math.log(MISS) / math.log(1 - p))


_ROTATIONS: dict[tuple[int, int, int, int], np.ndarray] = {}


def _rotation(d: int, table: int, level: int, m: int) -> np.ndarray:
    """m orthonormal directions; the same on every worker."""
    key = (d, table, level, m)
    if key not in _ROTATIONS:
        if len(_ROTATIONS) > 64:
            _ROTATIONS.clear()
        rng = np.random.default_rng([SEED, d, table, level])
        _ROTATIONS[key] = np.linalg.qr(rng.standard_normal((d, m)))[0].astype(np.float32)
    return _ROTATIONS[key]


def bucket_codes(q: np.ndarray, table: int, plan: list[int]) -> np.ndarray:
    """Each row's bucket in a table: the nearest axis of a random rotation, level by level."""
    code = np.full(len(q), table, np.int64)
    for level, m in enumerate(plan):
        z = q @ _rotation(q.shape[1], table, level, m)
        axis = np.abs(z).argmax(axis=1)
        code = code * (2 * m) + 2 * axis + (z[np.arange(len(q)), axis] < 0)
    return code


def _bucketed(nodes: DataFrame, first: int, count: int, n: int) -> DataFrame:
    """(d, code, node, q), a row per node and table."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column(0).to_numpy()
            for k in np.unique(d).tolist():
                part = batch.take(pa.array(np.flatnonzero(d == k)))
                q = matrix([part], 2).astype(np.float32)
                for t in range(first, first + count):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(bucket_codes(q, t, levels(n, k))), part.column(1), part.column(2)],
                        names=["d", "code", "node", "q"])

    return nodes.select("d", "node", "q").mapInArrow(work, "d int, code long, node long, q array<tinyint>")


def best_pairs(cosine: np.ndarray, nodes: np.ndarray, least: float, most: int) -> pa.RecordBatch:
    """(u, v, s): each row's best ``most`` entries at ``least`` or above, itself left out."""
    np.fill_diagonal(cosine, -2)
    m = len(nodes)
    if m - 1 > most:
        column = np.argpartition(-cosine, most - 1, axis=1)[:, :most]
        row = np.repeat(np.arange(m), most)
        column = column.ravel()
    else:
        row, column = np.divmod(np.arange(m * m), m)
    s = cosine[row, column]
    keep = s >= least
    return pa.RecordBatch.from_arrays([pa.array(nodes[row[keep]]), pa.array(nodes[column[keep]]),
                                       pa.array(s[keep].astype(np.float32))], names=["u", "v", "s"])


def _byte_cosines(q: np.ndarray) -> np.ndarray:
    q = q.astype(np.float32)
    q /= np.sqrt((q * q).sum(axis=1, keepdims=True))
    return q @ q.T


EDGE = "u long, v long, s float"


def _starts(nodes: DataFrame, first: int, count: int, n: int, floor: float) -> DataFrame:
    """Edges between the nodes of a bucket; a hot bucket is dealt out as several."""
    rows = _bucketed(nodes, first, count, n)
    hot = rows.groupBy("d", "code").count().filter(F.col("count") > BLOCK).select(
        "d", "code", F.ceil(F.col("count") / BLOCK).alias("pieces"))
    hot = broadcast_if_small(settle(hot, "hot-buckets"))
    piece = F.pmod(F.xxhash64("node", "code"), F.coalesce("pieces", F.lit(1)))
    dealt = rows.join(hot, ["d", "code"], "left").select("d", "code", piece.alias("piece"), "node", "q")
    dealt = dealt.repartition("d", "code", "piece").sortWithinPartitions("d", "code", "piece")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            node = numbers(group, 3)
            q = matrix(group, 4) if len(node) > 1 else None
            for i in range(0, len(node) - 1, 2 * BLOCK):  # pieces hold about BLOCK nodes
                yield best_pairs(_byte_cosines(q[i:i + 2 * BLOCK]), node[i:i + 2 * BLOCK], floor, LIST)

    return dealt.mapInArrow(work, EDGE)


# --- refinement --------------------------------------------------------------


def _ranked(edges: DataFrame, of: str, other: str) -> DataFrame:
    """``edges`` with their place in the list of ``of``; lists are cut to LONGEST, in pieces first."""
    piece = F.pmod(F.xxhash64(other), F.lit(PIECES))
    best = [F.desc("s"), F.xxhash64("u", "v")]
    first = edges.withColumn("rank", F.row_number().over(Window.partitionBy(of, piece).orderBy(*best)))
    return first.filter(F.col("rank") <= LONGEST).withColumn(
        "rank", F.row_number().over(Window.partitionBy(of).orderBy(*best))).filter(F.col("rank") <= LONGEST)


def _lists(edges: DataFrame, most: int, link: float) -> DataFrame:
    """The best LIST edges of every node; a list full of links goes on with links, up to ``most``."""
    distinct = edges.groupBy("u", "v").agg(F.max("s").alias("s"))
    return _ranked(distinct, "u", "v").filter(
        (F.col("rank") <= LIST) | ((F.col("s") >= link) & (F.col("rank") <= most))).select("u", "v", "s")


def _meet(nodes: DataFrame, lists: DataFrame, floor: float) -> DataFrame:
    """Edges among each node, its list and the lists it stands in, for nodes with a fresh edge."""
    back = _ranked(lists, "v", "u").filter(F.col("rank") <= LIST)
    both = lists.select(F.col("u").alias("center"), F.col("v").alias("node"), "fresh").union(
        back.select("v", "u", "fresh"))
    centers = both.groupBy("center").agg(F.max("fresh").alias("fresh")).filter("fresh").select("center")
    members = both.join(centers, "center", "left_semi").select("center", "node").union(
        centers.select("center", F.col("center").alias("node"))).distinct()
    rows = members.join(nodes.select("node", "d", "q"), "node").select("center", "node", "q")
    rows = rows.repartition("center").sortWithinPartitions("center")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for group in sorted_groups(batches, 1):
            held.append(best_pairs(_byte_cosines(matrix(group, 2)), numbers(group, 1), floor, LIST))
            if len(held) == 256:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return rows.mapInArrow(work, EDGE)


def descend(nodes: DataFrame, edges: DataFrame, cosine: float) -> DataFrame:
    """The neighbour graph (u, v, s) that neighbours-of-neighbours joins make of ``edges``."""
    floor, link = 2 * cosine * cosine - 1 - ROUNDING, cosine - ROUNDING
    lists = settle(_lists(edges, LIST, link).withColumn("fresh", F.lit(True)), "lists")
    most = LIST
    for _ in range(MOST_ROUNDS):
        most = min(2 * most, LONGEST)
        found = _meet(nodes, lists, floor).union(lists.select("u", "v", "s"))
        old = lists.select("u", "v", F.lit(True).alias("old"))
        lists = settle(_lists(found, most, link).join(old, ["u", "v"], "left").select(
            "u", "v", "s", F.col("old").isNull().alias("fresh")), "lists")
        total, fresh = lists.agg(F.count("*"), F.count_if("fresh")).head()
        if fresh <= QUIET * total:
            break
    return lists.select("u", "v", "s")


def exact_links(nodes: DataFrame, lists: DataFrame, cosine: float) -> DataFrame:
    """(a, b) edges whose cosine in double precision reaches the threshold."""
    likely = lists.filter(F.col("s") >= cosine - ROUNDING).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    rows = likely.join(nodes.select(F.col("node").alias("a"), "d", F.col("v").alias("x")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("v").alias("y")), "b").select("a", "b", "d", "x", "y")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column(2).to_numpy()
            for k in np.unique(d).tolist():
                part = batch.take(pa.array(np.flatnonzero(d == k)))
                keep = np.flatnonzero((unit(matrix([part], 3)) * unit(matrix([part], 4))).sum(axis=1) >= cosine)
                yield part.select(["a", "b"]).take(pa.array(keep))

    return settle(rows.mapInArrow(work, "a long, b long"), "vector-links")


# --- audit and result --------------------------------------------------------


def audit(nodes: DataFrame, near: DataFrame, cosine: float) -> float:
    """Mean share of its links that a sampled node has found, by comparing the sample with all nodes.

    The sample is the AUDITED nodes of least hash; nodes without links are left out. One without any gives 1.
    """
    sample = nodes.select("node", "d", "v", "copies").orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(AUDITED).collect()
    queries = {}
    for d in {r.d for r in sample}:
        own = [r for r in sample if r.d == d]
        queries[d] = (np.array([r.node for r in own], np.int64), unit(np.array([r.v for r in own])))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {d: np.zeros(len(ids), np.int64) for d, (ids, _) in queries.items()}
        for batch in batches:
            length = batch.column(0).to_numpy()
            for d, (ids, u) in queries.items():
                some = np.flatnonzero(length == d)
                if len(some):
                    part = batch.take(pa.array(some))
                    linked = unit(matrix([part], 2)) @ u.T >= cosine
                    linked &= part.column(1).to_numpy()[:, None] != ids[None, :]
                    total[d] += part.column(3).to_numpy() @ linked
        for d, (ids, _) in queries.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[d])], names=["node", "real"])

    true = nodes.select("d", "node", "v", "copies").mapInArrow(work, "node long, real long").groupBy("node").agg(
        F.sum("real").alias("real")).filter("real > 0")
    share = F.least(F.lit(1.0), F.coalesce("near", F.lit(0)) / F.col("real"))
    recall = true.join(near, "node", "left").agg(F.avg(share)).head()[0]
    return 1.0 if recall is None else float(recall)


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = LEAST_COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows at ``cosine`` or above; ``component_id``
    is the least key reached over links, its own included.
    """
    from tramline.llm.vector_counts import link_counts

    with_python(rows.sparkSession)
    named = rows.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    valid = named.filter(usable(F.col("v")))
    nodes = _nodes(valid)
    lengths = nodes.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    n, d = (nodes.count(), lengths[0].d) if lengths else (0, 1)
    done, more = 0, tables_needed(n, d, cosine)
    floor = 2 * cosine * cosine - 1 - ROUNDING
    edges = nodes.sparkSession.createDataFrame([], EDGE)
    for _ in range(MOST_AUDITS):
        edges = descend(nodes, edges.union(_starts(nodes, done, more, n, floor)), cosine)
        label = components(exact_links(nodes, edges, cosine))
        near = settle(link_counts(nodes, label, cosine), "near")
        if audit(nodes, near, cosine) >= RECALL:
            break
        done, more = done + more, done + more
    per_node = nodes.select("node", "v", "copies", "least").join(near, "node", "left").join(label, "node", "left").select(
        "v", "least", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("label"))
    named_class = per_node.groupBy("label").agg(F.min("least").alias("component_id"))
    linked = valid.join(per_node.join(named_class, "label").select("v", "n_links", "component_id"), "v").select(
        "key", "n_links", "component_id")
    alone = named.filter(~usable(F.col("v"))).select("key", F.lit(0).cast("long"), "key")
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id",
        (F.col("component_id").isNull() | F.col("key").eqNullSafe(F.col("component_id"))).alias("kept"))
