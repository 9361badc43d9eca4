"""op12 against numpy's eigensolver on exact covariances, and on rows full of edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from harborlens.llm import whitening
from harborlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, x string, component string"


def exact(vectors):
    """n, sums and the exact covariance over distinct integer vectors."""
    fit = sorted(set(vectors))
    n, dims = len(fit), len(fit[0])
    s = [sum(v[d] for v in fit) for d in range(dims)]
    mu = [Fraction(x, n) for x in s]
    v = [[float(sum((a[i] - mu[i]) * (a[j] - mu[j]) for a in fit) / n) for j in range(dims)] for i in range(dims)]
    return n, s, np.array(v)


def check(rows, got, k=4, near=1e-4):
    """Rows (id, integer vector or None) against what the operator gave."""
    rows = [(i, v) for i, v in rows if v is not None]
    n, s, v = exact([v for _, v in rows])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = v.trace()
    dims = len(s)
    k = min(k, dims)
    assert len(got) == len(rows) * k
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
        assert r.n == n and 0 <= (r.identity_error or 0) <= near
    want = sorted((i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in rows)
    for c in range(k):
        mine = sorted(by[c + 1], key=lambda r: (r.vec_id, int(r.deviation_digits)))
        assert [(r.vec_id, int(r.deviation_digits)) for r in mine] == want
        assert all(r.deviation == (d if d < 1 << 63 else None) for r, (_, d) in zip(mine, want))
        if values[c] <= 1e-12 * max(trace, 1e-300):
            assert near > 1 or all(r.whitened is None for r in mine)
            continue
        assert all(math.isclose(r.explained, values[c] / trace, rel_tol=1e-9) for r in mine)
        gap = min([abs(values[c] - e) for j, e in enumerate(values) if j != c], default=1)
        if gap > 1e-6 * trace:
            w = {(i, sum((n * a - b) ** 2 for a, b in zip(x, s))): (np.array([a - b / n for a, b in zip(x, s)]) @ vectors[:, c]) / math.sqrt(values[c]) for i, x in rows}
            mine_w = np.array([r.whitened for r in mine])
            want_w = np.array([w[k2] for k2 in want])
            assert min(np.abs(mine_w - want_w).max(), np.abs(mine_w + want_w).max()) < 1e-7


def to_int(vec, dims):
    return tuple([math.floor(256 * float(np.float32(c))) for c in vec] + [0] * (dims - len(vec)))


def test_against_eigh(spark):
    g = np.random.default_rng(3)
    mix = g.normal(size=(6, 6)) * [5, 3, 2, 1, .5, .1]
    vecs = [[float(np.float32(c)) for c in g.normal(size=6) @ mix] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vecs)] + [(500 + i, vecs[i % 3]) for i in range(200)] + [(7, vecs[9]), (600, [0.0] * 6), (601, [-0.0] * 6)]
    bad = [(700, None), (701, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (702, [float("nan")] + [0.0] * 5), (703, [float("-inf")] + [0.0] * 5)]
    short = [(800, []), (801, [2.5])]
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows + bad + short], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    check([(i, to_int(v, 6)) for i, v in rows + short], got)
    assert max(r.identity_error for r in got) < 1e-9


def test_flat_and_small_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "", ""), (2, [], "", "")], SCHEMA)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", ""), (None, [1.0, 2.0], "", "")], SCHEMA)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 and r.identity_error is None for r in one)
    rows = [(i, [float(i % 5), 3.0, -float(i % 5)]) for i in range(40)]              # one direction only
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)).collect()
    check([(i, to_int(v, 3)) for i, v in rows], got)
    assert {r.component: r.explained for r in got} == pytest.approx({1: 1.0, 2: 0.0, 3: 0.0})


def test_large_entries_stay_exact(spark):
    g = np.random.default_rng(5)
    vecs = [tuple(float(c) for c in row) for row in np.concatenate([g.normal(size=(40, 3)) * [1e13, 1e3, 1e-1], g.normal(size=(5, 3)) * 1e15])]
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    check([(i, tuple(math.floor(256 * c) for c in v)) for i, v in enumerate(vecs)], whitening.whiten(df).collect(), near=9)
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    check([(1, ((1 << 63) - 1, 256)), (2, (-(1 << 63), 512)), (3, (0, 1280))], whitening.whiten(huge).collect(), near=9)


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 30, 1 << 45, 1 << 60])
def test_exact_gram(top):
    g = np.random.default_rng(top % 97)
    m = g.integers(-top, top + 1, size=(5000 if top < 1 << 40 else 300, 4))
    want = m.astype(object).T @ m.astype(object)
    assert (whitening.exact_gram(m) == want).all()


def test_factorisation_of_graded_and_singular_matrices():
    g = np.random.default_rng(8)
    for d, scale in ((1, 1.0), (2, 1e-8), (7, 1e4), (40, 1.0)):
        b = g.normal(size=(d, max(1, d - 2))) * np.logspace(0, -4, max(1, d - 2)) * scale
        v = b @ b.T
        factor = whitening.pivoted_cholesky(v)
        assert np.allclose(factor @ factor.T, v, atol=1e-13 * np.abs(v).max())
        values, vectors = whitening.principal(v)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:max(1, d - 2)]
        assert np.allclose(values[:len(want)], want, rtol=1e-9, atol=1e-15 * want[0])
        assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-9)


def test_driver_table(spark):
    got = QUERIES["op12_whitening"](spark, SF_SMALL).collect()
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    check([(r.vec_id, to_int(r.embedding, 64)) for r in rows], got)
