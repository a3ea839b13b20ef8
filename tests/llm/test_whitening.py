import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening


def brute(vectors, k):
    x = np.unique(np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object).astype(np.int64), axis=0)
    y = x - x.mean(0)
    e, v = np.linalg.eigh(y.T @ y / len(x))
    return x, e[::-1][:k], v[:, ::-1][:, :k], np.trace(y.T @ y / len(x))


def compare(out, rows, k=16):
    fine = [(i, v) for i, v in rows if v is not None and len(v) == 12 and all(c is not None and np.isfinite(c) for c in v)]
    x, e, v, trace = brute([v for _, v in fine], k)
    n, s = len(x), x.sum(0)
    assert len(out) == len(fine) * k and {r.n for r in out} == {n}
    assert max(r.identity_error for r in out) < 1e-9 and max(r.residual for r in out) <= 1e-11
    w = {}
    for r in out:
        w.setdefault(r.component, []).append((r.vec_id, r.whitened))
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    for c in range(1, k + 1):
        p = {i: float((np.floor(64 * np.array(a, float)) + 1_000_000 - s / n) @ v[:, c - 1] / np.sqrt(e[c - 1])) for i, a in fine}
        got = dict(w[c])
        sign = np.sign(sum(got[i] * p[i] for i in p))
        assert all(abs(got[i] * sign - p[i]) < 1e-7 for i in p)
    far = {r.vec_id: r.deviation for r in out}
    for i, a in fine:
        xi = [int(np.floor(64 * float(c))) + 1_000_000 for c in a]
        assert far[i] == sum((n * q - int(t)) ** 2 for q, t in zip(xi, s, strict=True))


def test_equals_a_full_decomposition(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(12) * np.arange(1, 13)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(2000, None), (2001, [None] + [0.0] * 11), (2002, [float("nan")] + [0.0] * 11), (2003, [float("-inf")] * 12), (2004, [1.0]), (2005, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    compare(whitening.whiten_embeddings(df, components=6).collect(), rows, 6)
    compare(whitening.whiten_embeddings(df.withColumn("component", F.lit("x")).withColumn("n", F.lit(1)), components=12).collect(), rows, 12)


def test_many_rounds_on_a_wide_operator():
    """Here iterate, residual and direction blocks span a small part of the space."""
    rng = np.random.default_rng(2)
    d = 400
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = np.concatenate([100 * 0.9 ** np.arange(30), rng.random(d - 30)])
    v = (q * values) @ q.T
    e, x, size, rounds = whitening.lobpcg(lambda b: v @ b, d, 16)
    assert rounds > 3 and np.allclose(e, np.sort(values)[::-1][:16], rtol=1e-12) and size.max() <= 1e-11 * e[0]
    assert np.abs(x.T @ x - np.eye(16)).max() < 1e-12 and np.abs(v @ x - x * e).max() < 1e-9


def test_equal_eigenvalues_and_low_rank(spark):
    rng = np.random.default_rng(3)
    low = rng.standard_normal((100, 3)) @ np.array([[100.0, 0, 0, 0, 0], [0, 100, 0, 0, 0], [0, 0, 1000, 0, 0]])
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(low)], "vec_id long, embedding array<float>")
    out = whitening.whiten_embeddings(df).collect()
    assert {r.component for r in out} == {1, 2, 3} and max(r.identity_error for r in out) < 1e-9
    corners = [(int(8 * a + 4 * b + 2 * c), [a, b, c]) for a in (0.0, 1.0) for b in (0.0, 1.0) for c in (0.0, 1.0)]
    out = whitening.whiten_embeddings(spark.createDataFrame(corners, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 24 and max(r.identity_error for r in out) < 1e-9 and all(r.explained == pytest.approx(1 / 3) for r in out)


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, x string, w int"
    assert whitening.whiten_embeddings(spark.createDataFrame([], kind)).columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whiten_embeddings(spark.createDataFrame([(1, [], "a", 1), (2, None, "a", 1)], kind)).count() == 0
    assert whitening.whiten_embeddings(spark.createDataFrame([(i, [1.0, 2.0], "a", 1) for i in range(9)], kind)).count() == 0
    out = whitening.whiten_embeddings(spark.createDataFrame([(None, [1.0, 2.0], "a", 1), (None, [1.0, 2.0], "a", 1), (3, [3.0e38, -3.0e38], "b", 1)], kind)).collect()
    assert len(out) == 3 and sum(r.vec_id is None for r in out) == 2 and out[0].identity_error < 1e-9
    huge = np.array([[1 << 40, 5], [3, -(1 << 40)]], dtype=np.int64)
    z = whitening.scaled(huge, 1 << 30, np.array([1, 2], object))
    assert z.tolist() == [[(1 << 70) - 1, 5 * (1 << 30) - 2], [3 * (1 << 30) - 1, -(1 << 70) - 2]]


def test_all_given_vectors(spark, sf):
    docs = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    out = whitening.whiten_embeddings(docs).collect()
    x, e, v, trace = brute([a for _, a in rows if a is not None], 16)
    w = np.zeros((len(rows), 16))
    at = {i: k for k, (i, _) in enumerate(rows)}
    for r in out:
        w[at[r.vec_id], r.component - 1] = r.whitened
    want = (np.floor(64 * np.array([a for _, a in rows], float)) + 1_000_000 - x.sum(0) / len(x)) @ v / np.sqrt(e)
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-6 and len(out) == 16 * len(rows)
