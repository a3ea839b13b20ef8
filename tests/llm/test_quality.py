import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm.quality import Features, Ordinal, fit_ordinal, keep_good, learn_quality, score_quality
from quarry.session import table


def test_ordered_grades_are_recovered():
    rnd = random.Random(1)
    rows = []
    for _ in range(1500):
        x = rnd.uniform(-3, 3)
        y = sum(x + math.log(1 / rnd.uniform(1e-6, 1 - 1e-6) - 1) * 0.3 > c for c in (-1, 0.5, 1.5))
        rows.append((np.array([3, 9]), np.array([x, 1.0]), y))
    m = fit_ordinal(rows, 16, epochs=20)
    assert m.grades == (0, 1, 2, 3) and all(np.diff(m.cuts) > 0) and m.weights[3] > 0.8
    low, high = m.rate(np.array([3, 9]), np.array([-3.0, 1.0]), 2), m.rate(np.array([3, 9]), np.array([3.0, 1.0]), 2)
    assert low[0] < 0.5 and high[0] > 2.5 and low[1] < 0.1 and high[1] > 0.9
    rate = [m.rate(r[0], r[1], 2)[0] for r in rows]
    assert np.corrcoef(rate, [r[2] for r in rows])[0, 1] > 0.85


def test_fit_is_near_the_optimum_of_a_plain_one():
    """Against full gradient descent on the same likelihood, to its end."""
    rnd = np.random.default_rng(2)
    x = np.column_stack([rnd.normal(size=(800, 3)), np.ones(800)])
    y = ((x @ [1.0, -0.7, 0.4, 0.0] + rnd.logistic(size=800))[:, None] > [-1.0, 0.8]).sum(axis=1)

    def loss(w, cuts):
        p = np.column_stack([np.ones(800), 1 / (1 + np.exp(-(x[:, :3] @ w)[:, None] + cuts[None, :])), np.zeros(800)])
        return -np.log(p[np.arange(800), y] - p[np.arange(800), y + 1]).mean()

    z = np.array([0.0, 0.0, 0.0, -0.5, 0.5])
    for _ in range(1500):
        g = np.array([(loss(z[:3] + e[:3], z[3:] + e[3:]) - loss(z[:3] - e[:3], z[3:] - e[3:])) / 2e-5 for e in np.eye(5) * 1e-5])
        z -= 0.8 * g
    best = loss(z[:3], z[3:])
    m = fit_ordinal([(np.array([0, 1, 2]), r[:3], int(k)) for r, k in zip(x, y)], 4, epochs=30)
    assert best <= loss(m.weights[:3], m.cuts) < best + 0.01


def test_long_words_are_read_whole():
    f = Features(1 << 20)
    a, b = (dict(zip(*(v.tolist() for v in f("x" * 60 + c)))) for c in "yz")
    assert set(a) != set(b)


def test_rate_is_the_sum_of_tails():
    m = Ordinal((1, 2, 5), np.array([0.0, 1.0]), np.array([2.0, 0.0]))
    p1, p2 = 1 / (1 + math.exp(-2)), 1 / (1 + math.exp(-1))
    mean, tail = m.rate(np.array([0]), np.array([1.0]), 5)
    assert abs(mean - (1 + p1 + 3 * p2)) < 1e-12 and abs(tail - p2) < 1e-12
    assert m.rate(np.array([0]), np.array([1.0]), 1)[1] == 1.0 and m.rate(np.array([0]), np.array([1.0]), 9)[1] == 0.0


def test_features_against_plain_counts():
    f = Features(1 << 20)
    t = "Aa aa AA 12 12 é!! aa"
    idx, val = f(t)
    got = dict(zip(idx.tolist(), val.tolist()))
    assert abs(got[f._at("waa")] - math.sqrt(4 / 7)) < 1e-12 and abs(got[f._at("s9")] - math.sqrt(2 / 7)) < 1e-12
    assert got[f._at("distinct=7")] == 1.0 and len(f("")[0]) == 8


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = learn_quality(docs, labels.where(~fold))
    rows = score_quality(docs, m).where(fold).join(labels, "doc_id").select("tail_probability", "quality").collect()
    pos, neg = [r[0] for r in rows if r[1] == 1], [r[0] for r in rows if r[1] == 0]
    assert sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg) > 0.99
    assert sum(p >= 0.35 for p in pos) / len(pos) > 0.99 and sum(q >= 0.35 for q in neg) / len(neg) < 0.1


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "word " * 30_000, "c"), (2, "word " * 30_000, "c")], "doc_id long, text string, expected_grade string")
    none = learn_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert all(r.tail_probability == 1.0 for r in score_quality(docs, none).collect())
    one = learn_quality(docs, spark.createDataFrame([(2, 1), (2, 1), (None, 0), (1, None)], "doc_id long, quality int"))
    assert one.grades == (1,)
    kept = keep_good(docs, one)
    assert kept.columns == docs.columns and kept.count() == 4
    assert score_quality(docs.limit(0), one).count() == 0


def test_the_sample_bound_is_kept(spark):
    rows = [(i, "good plain words here" if i % 2 else "$$$ ### 000 !!!", i % 2) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    m = learn_quality(docs, docs.select("doc_id", "quality"), sample_rows=200)
    got = {r.doc_id: r.tail_probability for r in score_quality(docs.select("doc_id", "text").limit(20), m).collect()}
    assert all((p > 0.5) == (i % 2 == 1) for i, p in got.items())
