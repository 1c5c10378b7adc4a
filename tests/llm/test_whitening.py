import numpy as np
import pytest

from stratalake.llm import queries, whitening as w


def symmetric(seed, n, rank=None):
    a = np.random.default_rng(seed).normal(size=(n, rank or n))
    return a @ a.T


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 40])
def test_inertia_counts(n):
    for seed in range(5):
        a = symmetric(seed, n) - (n if seed % 2 else 0) * np.eye(n)
        values = np.linalg.eigvalsh(a)
        for shift in np.r_[(values[1:] + values[:-1]) / 2, values.min() - 1, values.max() + 1, 0.3]:
            assert w.above(a, shift) == (values > shift).sum()
    assert w.above(np.zeros((n, n)), 0.0) == 0 and w.above(np.eye(n)[::-1].copy(), 0.0) == (n + 1) // 2


@pytest.mark.parametrize("matrix", [symmetric(1, 30), symmetric(2, 12, 3), np.eye(10), np.diag([5.0, 5, 5, 2, 2, 1e-9, 0, 0]), np.diag([3.0, 3 - 1e-13, 3 - 1e-7, 1]), 7 * np.ones((6, 6)), np.zeros((4, 4)), np.array([[2.0]]), symmetric(3, 64) * 1e12])
def test_leading_pairs(matrix):
    values, vectors = w.Slicer(matrix).leading(8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    want = want[want > 1e-11 * max(1e-300, want.max())]
    assert len(values) == len(want) or len(want) and abs(want[-1]) < 1e-8 * want[0]
    np.testing.assert_allclose(values, want[: len(values)], rtol=1e-11, atol=1e-13 * max(1.0, matrix.max()))
    if len(values):
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-10
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11 * max(values)
        assert all(v[np.abs(v).argmax()] > 0 for v in vectors)


def brute(vectors):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    centred = ((n * x - s) / n).astype(float)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return n, [int(k) for k in ((n * x - s) ** 2).sum(axis=1)], e[::-1][:8], u.T[::-1][:8], np.trace(v), centred


def test_query_equals_numpy(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, e, u, trace, centred = brute([r.embedding for r in rows])
    got = {(r.vec_id, r.component): r for r in queries.op13_embedding_whitening(spark, data).collect()}
    assert len(got) == 8 * len(rows) and {r.n for r in got.values()} == {n}
    for k in range(8):
        white = centred @ u[k] / np.sqrt(e[k])
        mine = np.array([got[r.vec_id, k + 1].whitened for r in rows])
        assert min(np.abs(mine - white).max(), np.abs(mine + white).max()) < 1e-7
        assert abs(got[rows[0].vec_id, k + 1].explained - e[k] / trace) < 1e-12
    assert [got[r.vec_id, 1].deviation for r in rows] == deviation
    assert {r.identity_error for r in got.values()} == {got[rows[0].vec_id, 1].identity_error} and got[rows[0].vec_id, 1].identity_error < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, -2.0]), (1, [0.5, 1.0, -2.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]), (7, [-inf, 0.0, 0.0]), (None, [3.0, 2.0, 2.5]), (8, [1.0, 2.0]), (9, [-1.0, 0.25, 7.0]), (10, [1e300, 0.0, 0.0])]
    docs = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, whitened string, white double").repartition(3)
    got = w.whiten(docs).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "9", "None"] and {r.whitened for r in got} == {"x"}
    n, deviation, e, u, trace, _ = brute([v for i, v in rows if i in (1, 9, None)])
    assert {r.white.n for r in got} == {n} and sorted(r.white.deviation for r in got) == sorted(deviation)
    assert all(len(r.white.whitened) == 2 for r in got) and got[0].white.identity_error < 1e-9  # of rank 2
    assert abs(sum(got[0].white.explained) - 1) < 1e-9
    one = w.whiten(docs.where("vec_id = 9")).collect()
    assert len(one) == 1 and one[0].white.whitened == [] and one[0].white.identity_error is None and one[0].white.deviation == 0
    assert w.whiten(docs.where("false")).count() == 0 and w.whiten(docs.where("vec_id IN (2, 3)")).count() == 0


def test_large_entries_are_summed_exactly(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(0, 1e9, 3)]) for i in range(50)]
    got = w.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, deviation, *_ = brute([v for _, v in rows])
    assert all(d >= 1 << 63 for d in deviation) and all(r.white.deviation is None for r in got) and got[0].white.identity_error < 1e-6
