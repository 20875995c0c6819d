"""Whitening and near duplicates of embeddings against brute force."""

import math
import os

import numpy as np
import pytest

from tests.llm import brute
from tramline.llm import near_vectors as nv
from tramline.llm.catalog import QUERIES
from tramline.llm.components import components
from tramline.llm.vector_counts import link_counts
from tramline.llm.whitening import lattice_point, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, node string, x int, key string, v int"


def write(spark, rows, folder):
    spark.createDataFrame([(k, v, 0, "n", 1, "k", 2) for k, v in rows], SCHEMA).write.parquet(os.path.join(folder, "embeddings.parquet"))
    return folder


def cluster(rng, d, n, least, most):
    """n unit vectors whose cosine to a common center lies in [least, most]."""
    c = rng.standard_normal(d)
    c /= np.linalg.norm(c)
    out = []
    for s in rng.uniform(least, most, n):
        y = rng.standard_normal(d)
        y -= (y @ c) * c
        out.append(s * c + math.sqrt(1 - s * s) * y / np.linalg.norm(y))
    return out


def odd_vectors(d=16):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, v)) for v in (*rng.standard_normal((40, d)), *cluster(rng, d, 60, 0.93, 0.99), *cluster(rng, d, 30, 0.96, 0.999))]
    vectors += [vectors[5]] * 4 + [[3 * c for c in vectors[6]], [-c for c in vectors[7]]]
    rows = list(enumerate(vectors))
    rows += [(1000, None), (1001, []), (1002, [0.0] * d), (1003, [None, *vectors[0][1:]]), (1004, [math.nan, *vectors[0][1:]]),
             (1005, [math.inf, *vectors[0][1:]]), (1006, vectors[0][:5]), (1007, vectors[0][:5]), (None, vectors[8]), (None, vectors[9]),
             (None, [1.0] + [0.0] * (d - 1)), (3, vectors[50]), (3, vectors[50])]
    return [(k, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for k, v in rows]


@pytest.fixture(scope="module")
def vector_dir(spark, tmp_path_factory):
    return write(spark, odd_vectors(), str(tmp_path_factory.mktemp("vectors")))


@pytest.fixture(scope="module")
def none_dir(spark, tmp_path_factory):
    return write(spark, [], str(tmp_path_factory.mktemp("no-vectors")))


@pytest.mark.parametrize("name", ["op11_embedding_whitening", "op13_embedding_near_dedup"])
def test_no_rows(spark, none_dir, name):
    assert QUERIES[name](spark, none_dir).collect() == []


def bag(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_whitening(spark, vector_dir):
    rows = [(k, v) for k, v in odd_vectors() if v is not None and len(v) == 16 and all(c is not None and math.isfinite(c) for c in v)]
    n, total, vectors, e = brute.whitening([v for _, v in rows])
    got = QUERIES["op11_embedding_whitening"](spark, vector_dir).collect()
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    point = lambda v: [int(np.floor(64 * c)) + 1_000_000 for c in v]
    want = sorted((k is None, k or 0, sum((n * x - s) ** 2 for x, s in zip(point(v), total, strict=True))) for k, v in rows)
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in got if r.component == 1) == want
    by_id = {(r.vec_id, r.component): r for r in got}
    for k, v in rows:
        if k is None or k == 3:
            continue
        z = np.array([(n * x - s) / n for x, s in zip(point(v), total, strict=True)]) @ vectors / np.sqrt(e[:16])
        for c in range(16):
            r = by_id[k, c + 1]
            assert abs(abs(r.whitened) - abs(z[c])) < 1e-7 and abs(r.explained / (e[c] / e.sum()) - 1) < 1e-9
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_without_full_rank(spark):
    """A constant entry and two entries that move together leave fewer components."""
    rng = np.random.default_rng(4)
    vectors = [[a, 0.5, b, a] for a, b in rng.standard_normal((300, 2)).tolist()]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = whiten(rows).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-6
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5, [[7.0]], [[1e30, 1.0], [-1e30, 2.0], [0.0, 0.0]]])
def test_whitening_of_few(spark, vectors):
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = whiten(rows).collect()
    assert len(got) == (3 if len(vectors) == 3 else 0)  # beside 1e30 the other entry has no spread in double precision


def test_points_beyond_32_bits_stay_exact(spark):
    rows = spark.createDataFrame([(1, [2.0 ** 33]), (2, [-(2.0 ** 33)]), (3, [2.0 ** 33])], "vec_id long, embedding array<double>")
    assert rows.select(lattice_point(rows.embedding)[0]).first()[0] == 2 ** 39 + 1_000_000
    got = {r.vec_id: r for r in whiten(rows).collect()}
    assert got[1].n == 2 and got[1].deviation is None and abs(abs(got[2].whitened) - 1) < 1e-12


def test_near_vectors(spark, vector_dir):
    got = QUERIES["op13_embedding_near_dedup"](spark, vector_dir).collect()
    want = brute.near_vectors(odd_vectors())
    assert sum(w[1] > 20 for w in want) > 20
    assert bag((r.vec_id, r.n_links, r.component_id) for r in got) == bag(want)
    assert all(r.kept == (r.component_id is None or r.vec_id == r.component_id) for r in got)


def test_near_vectors_sql(spark, vector_dir):
    import duckdb

    from tests.oracle import compare
    from tramline.llm.catalog import ORACLE_SQL
    name, con = "op13_embedding_near_dedup", duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{vector_dir}/embeddings.parquet/*.parquet')")
    assert compare(spark, QUERIES[name], ORACLE_SQL[name], vector_dir, con)["ok"]


def test_many_small_buckets_and_saturated_lists(spark, monkeypatch):
    """Buckets of a few nodes, hot ones dealt out, cells of a few nodes: all links of loose and tight groups."""
    rng = np.random.default_rng(11)
    d = 24
    groups = [cluster(rng, d, 80, 0.95, 0.975), cluster(rng, d, 150, 0.985, 0.999), cluster(rng, d, 40, 0.94, 0.955)]
    chain = [np.eye(d)[0]]  # each near the next only
    for k in range(1, 20):
        chain.append(0.93 * chain[-1] + math.sqrt(1 - 0.93 ** 2) * np.eye(d)[k])
    pairs = [v for _ in range(60) for v in cluster(rng, d, 2, 0.9755, 0.98)]
    vectors = [v for g in groups for v in g] + chain + pairs + list(rng.standard_normal((300, d)))
    order = rng.permutation(len(vectors))
    rows = [(int(i), [float(c) for c in vectors[i]]) for i in order]
    monkeypatch.setattr(nv, "BUCKET", 16)
    monkeypatch.setattr(nv, "BLOCK", 32)
    got = nv.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = brute.near_vectors(rows)
    true, found = sum(w[1] for w in want), sum(r.n_links for r in got)
    exact = {w[0]: w for w in want}
    assert all(r.n_links <= exact[r.vec_id][1] for r in got)
    assert found >= 0.99 * true
    assert sum(r.n_links == exact[r.vec_id][1] and r.component_id == exact[r.vec_id][2] for r in got) >= 0.97 * len(rows)


def test_cells_count_exactly(spark):
    """Given the components, counts are exact however the components are cut."""
    rng = np.random.default_rng(12)
    d = 12
    vectors = cluster(rng, d, 90, 0.93, 0.97) + cluster(rng, d, 90, 0.99, 0.9999)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    valid = spark.createDataFrame(rows, "key long, v array<double>")
    nodes = nv._nodes(valid)
    key = {r.node: r.least for r in nodes.select("node", "least").collect()}
    back = {k: n for n, k in key.items()}
    u = np.array([np.array(v) / np.linalg.norm(v) for v in vectors])
    linked = u @ u.T >= 0.9
    links = spark.createDataFrame([(back[int(i)], back[int(j)]) for i, j in zip(*np.nonzero(linked), strict=True) if i < j], "a long, b long")
    label = components(links)
    for block in (7, 25, 1024):
        got = {key[r.node]: r.near for r in link_counts(nodes, label, 0.9, block).collect()}
        assert got == {i: int(linked[i].sum()) - 1 for i in range(len(rows)) if linked[i].sum() > 1}


def test_tables_and_audit(spark):
    assert nv.levels(200, 64) == [] and nv.tables_needed(200, 64, 0.9) == 1
    assert 4 <= nv.tables_needed(50_000, 64, 0.9) <= 20 and nv.tables_needed(10 ** 9, 64, 0.9) <= 80
    rng = np.random.default_rng(13)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(cluster(rng, 8, 50, 0.97, 0.99))]
    nodes = nv._nodes(spark.createDataFrame(rows, "key long, v array<double>"))
    none = spark.createDataFrame([], "node long, near long")
    assert nv.audit(nodes, none, 0.9) == 0.0
    full = nodes.selectExpr("node", "49L as near")
    assert nv.audit(nodes, full, 0.9) > 0.99
