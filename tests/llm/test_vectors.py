"""Whitening against exact fractions, nearest neighbours against all pairs."""

import math
import os
import sys
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import sf_dir, spark  # noqa: E402,F401

from lexlake.llm import ann, whitening  # noqa: E402
from lexlake.llm.common import documents  # noqa: E402

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, id int, vec int, x int, key string, n int, score int, block int, tree int"


def table(spark, rows, schema=SCHEMA):  # noqa: F811
    return spark.createDataFrame([(i, v, 1, 2, 3, "k", 4, 5, 6, 7) for i, v in rows], schema)


def some_vectors(n, dims, seed=1):
    return np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32).tolist()


def odd_rows(dims=6):
    good = list(enumerate(some_vectors(40, dims)))
    bad = [(100, None), (101, []), (102, [None] * dims), (103, [NAN] * dims), (104, [INF] * dims), (105, [1.0] * (dims + 1)), (106, [1.0])]
    return good + bad + [(None, good[3][1]), (7, good[7][1]), (7, good[7][1]), (200, good[7][1]), (300, [0.0] * dims), (301, [-0.0] * dims)]


# --- whitening ---------------------------------------------------------------------------


def exact_fit(vectors):
    """Distinct x vectors, their sums and covariance, by fractions."""
    x = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors})
    n, dims = len(x), len(x[0])
    s = [sum(v[k] for v in x) for k in range(dims)]
    z = [[Fraction(c) - Fraction(t, n) for c, t in zip(v, s, strict=True)] for v in x]
    cov = np.array([[float(sum(v[i] * v[j] for v in z) / n) for j in range(dims)] for i in range(dims)])
    return n, s, cov


def held(vectors, got, k):
    n, s, cov = exact_fit(vectors)
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1], parts[:, ::-1]
    for c in range(k):
        rows = [r for r in got if r.component == c + 1]
        assert len(rows) == len(vectors)
        x = np.array([[math.floor(256 * float(v)) for v in np.float32(r.v)] for r in rows])
        want = (x - np.array(s) / n) @ parts[:, c] / math.sqrt(values[c])
        have = np.array([r.whitened for r in rows])
        assert min(abs(have - want).max(), abs(have + want).max()) < 1e-9
        assert all(abs(r.explained - values[c] / np.trace(cov)) < 1e-12 and r.n == n for r in rows)
        assert [r.deviation for r in rows] == [sum((n * int(a) - t) ** 2 for a, t in zip(v, s, strict=True)) for v in x]
        assert all(r.identity_error < 1e-10 for r in rows)


def test_whitening_odd_rows(spark):  # noqa: F811
    rows = odd_rows()
    kept = [v for i, v in rows if v and len(v) == 6 and v[0] is not None and math.isfinite(v[0])]
    given = table(spark, rows)
    got = whitening.whiten(given)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 4 * len(kept)
    # the vector of each row, to hold its figures against
    vectors = {i: v for i, v in rows if i is not None} | {None: rows[3][1]}
    held(kept, [type("R", (), r.asDict() | {"v": vectors[r.vec_id]}) for r in got.collect()], 4)


def test_whitening_documents(spark, sf_dir):  # noqa: F811
    given = documents(spark, sf_dir, "embeddings")
    rows = {r.vec_id: r.embedding for r in given.collect()}
    got = [type("R", (), r.asDict() | {"v": rows[r.vec_id]}) for r in whitening.whiten(given).collect()]
    held(list(rows.values()), got, 4)


def test_whitening_without_spread(spark):  # noqa: F811
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    got = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(got) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in got)
    flat = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 9.0])])).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}


def test_whitening_of_large_entries(spark):  # noqa: F811
    rows = [(i, [1e9 * a, 1e9 * b]) for i, (a, b) in enumerate([(1, 2), (2, 1), (3, 5), (5, 4)])] + [(9, [1e300, 0.0])]
    got = whitening.whiten(table(spark, rows, SCHEMA.replace("array<float>", "array<double>"))).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3}
    # beyond 64 bits there is no exact figure
    assert all(r.deviation is None for r in got) and all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("values", [
    np.random.default_rng(4).random(40) * 100, np.r_[[5.0] * 10, 5 + 1e-9 * np.arange(10), 1, 2, 3, 1e-8, 0, 0],
    np.ones(16), np.zeros(5), np.array([3.0]), 1 + 1e-6 * np.random.default_rng(5).random(40), np.r_[1e6, 1 + 1e-3 * np.random.default_rng(6).random(30)],
])
def test_eigenvectors(values):
    size = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(7).normal(size=(size, size)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.eigen(a)
    wide = a.astype(np.longdouble) @ x - x.astype(np.longdouble) * got
    top = max(abs(values).max(), 1e-300)
    assert float(abs(wide).max()) / top < 5e-16
    assert float(abs(x.astype(np.longdouble).T @ x - np.eye(size)).max()) < 5e-16
    assert abs(got - np.sort(values)[::-1]).max() / top < 5e-15


# --- nearest neighbours ------------------------------------------------------------------


def all_pairs(rows, asks, k=20):
    """Exact answers; rows alike in id and vector are one."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, q in rows:
        if asks(i):
            near = sorted((-float(np.dot(q, v)), j) for j, v in rows if (j, v) != (i, q))
            out.setdefault(i, []).append(near[:k])
    return out


def test_nearest_odd_rows(spark):  # noqa: F811
    rows = odd_rows()
    got = ann.nearest(table(spark, rows), F.col("id") % 20 == 0, k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if i is not None and i < 300 and v and len(v) == 6 and v[0] is not None and math.isfinite(v[0])]
    want = all_pairs(kept, lambda i: i % 20 == 0, 5)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(found) == set(want) == {0, 20, 200}
    for i, near in found.items():
        assert [j for _, j in near] == [j for _, j in want[i][0]]
        assert np.allclose([s for s, _ in near], [s for s, _ in want[i][0]], atol=1e-12)


def test_nearest_among_copies_and_ties(spark):  # noqa: F811
    """A third of all rows are one vector, many others score alike: smaller ids win."""
    rows = [(3 * i, [1.0, 0.0, 0.0]) for i in range(300)]
    rows += [(3 * i + 1, [0.5, float(i % 7), 1.0]) for i in range(300)] + [(3 * i + 2, [0.0, 0.0, float(i + 1)]) for i in range(300)]
    got = {}
    for r in ann.nearest(table(spark, rows), F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    want = all_pairs(rows, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    for i, near in got.items():
        assert [(s, j) for _, s, j in sorted(near)] == want[i][0]


def test_nearest_in_few_rows(spark):  # noqa: F811
    assert ann.nearest(table(spark, []), F.col("id") % 20 == 0).collect() == []
    assert ann.nearest(table(spark, [(0, None), (20, [0.0, 0.0])]), F.col("id") % 20 == 0).collect() == []
    assert ann.nearest(table(spark, [(0, [1.0, 0.0])]), F.col("id") % 20 == 0).collect() == []
    assert ann.nearest(table(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])]), F.col("id") % 20 == 0).collect() == []
    got = ann.nearest(table(spark, [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (0, [1.0, 1.0])]), F.col("id") % 20 == 0).collect()
    # two rows of one id: each is the other's neighbour
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 1, 2.0), (0, 1, 1, 2.0), (0, 2, 0, 1.0), (0, 2, 0, 1.0)]


@pytest.mark.parametrize("long", [False, True])
def test_recall_and_scores(spark, monkeypatch, long):  # noqa: F811
    """At least nine in ten of the true ones, also where lengths differ and blocks are many."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(6000, 24))
    v = v / np.linalg.norm(v, axis=1)[:, None] if not long else v * rng.uniform(0.5, 3, 6000)[:, None]
    v = v.astype(np.float32)
    for name, size in (("BLOCK", 16), ("ASKED", 8), ("CELL", 2)):
        monkeypatch.setattr(ann, name, size)
    got = ann.nearest(table(spark, list(enumerate(v.tolist()))), F.col("id") % 20 == 0, sample=1500, share=0.9).toPandas()
    assert len(got) == 300 * 20
    scores = v[::20].astype(np.float64) @ v.astype(np.float64).T
    scores[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    floor = np.partition(scores, -20, axis=1)[:, -20]
    own = scores[got.query_id // 20, got.vec_id]
    assert np.abs(own - got.score).max() < 1e-12
    assert (own >= floor[got.query_id // 20] - 1e-12).mean() >= 0.9
    assert (got.vec_id != got.query_id).all() and not got.duplicated(["query_id", "vec_id"]).any()
