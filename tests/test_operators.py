import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import corpus as C
from quarry.operators import evaluation as E
from quarry.operators import governance as G
from quarry.operators import retrieval as R


def test_bm25_edges(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a b"), (3, None), (4, "")], "doc_id long, text string")
    q = spark.createDataFrame([(7, "a a"), (8, "zzz"), (9, None)], "qid long, text string")
    got = R.bm25(docs, q, 5).collect()
    assert [(r.qid, r.doc_id, r.rank) for r in got] == [(7, 1, 1), (7, 2, 2)]
    assert R.bm25(docs, q, 0).count() == 0


def test_dense_in_blocks_equals_whole(spark):
    rnd = np.random.default_rng(1)
    v = spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=8)]) for i in range(300)], "doc_id long, vector array<float>")
    q = v.where("doc_id % 10 = 0").withColumnRenamed("doc_id", "qid")
    a = {(r.qid, r.rank): r.doc_id for r in R.dense(v, q, 5).collect()}
    b = {(r.qid, r.rank): r.doc_id for r in R.dense(v, q, 5, block=7).collect()}
    assert a == b and len(a) == 150 and all(a[i, 1] == i for i in range(0, 300, 10))


def test_mmr_against_plain_loop(spark):
    rnd = np.random.default_rng(3)
    vec = rnd.normal(size=(12, 4))
    rows = [(1, i, i + 1, float(rnd.random()), [float(x) for x in vec[i]], f"k{i % 3}") for i in range(12)]
    df = spark.createDataFrame(rows, "qid long, doc_id long, rank int, score double, vector array<double>, key string")
    u = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    chosen = []
    while len(chosen) < 6:
        best = max((i for i in range(12) if i not in chosen), key=lambda i: (round(0.5 * rows[i][3] - 0.5 * max((u[i] @ u[j] for j in chosen), default=0.0), 12), -i))
        chosen.append(best)
    got = [r.doc_id for r in R.mmr(df, 6, 0.5).orderBy("rank").collect()]
    assert got == chosen
    capped = [r.doc_id % 3 for r in R.mmr(df, 12, 0.5, cap=2).collect()]
    assert all(capped.count(k) <= 2 for k in range(3))


def test_token_budget_skips(spark):
    df = spark.createDataFrame([(1, 10, 1, 5), (1, 11, 2, 9), (1, 12, 3, 4), (2, 20, 1, 50), (2, 21, 2, 1)], "qid long, doc_id long, rank int, tokens long")
    assert [(r.qid, r.doc_id, r.used) for r in R.token_budget(df, 10).orderBy("qid", "position").collect()] == [(1, 10, 5), (1, 12, 9)]


def test_bootstrap_and_permutation(spark):
    rnd = random.Random(2)
    rows = [("m", f"c{i % 12}", rnd.random(), rnd.random() - 0.4) for i in range(200)] + [("z", "c1", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "metric string, cluster string, a double, b double")
    ci = {r.metric: r for r in E.bootstrap_ci(df.select("metric", "cluster", F.col("a").alias("value")), 2000).collect()}
    assert ci["m"].lo < ci["m"].mean < ci["m"].hi and ci["z"].lo == ci["z"].hi == 1.0
    p = {r.metric: r.p for r in E.permutation_p(df, 2000).collect()}
    assert p["m"] < 0.01 and p["z"] == 1.0


def test_near_duplicates_within_a_source(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, base + " x y", "a"), (3, base, "b"), (4, "other words entirely here now", "a"), (5, None, "a"), (6, base, "a")]
    got = C.near_duplicate_clusters(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.component) for r in got) == [(1, 1), (2, 1), (6, 1)]


def test_near_duplicates_in_a_crowded_bucket(spark):
    rnd = random.Random(11)
    base, rows = [f"t{i}" for i in range(400)], []
    for i in range(240):  # a template family: each twentieth text is near the others of its kind, those between are near none
        words = list(base)
        for at in rnd.sample(range(400), 2 if i % 20 == 7 else 6):
            words[at] = f"v{i}_{at}"
        rows.append((i, " ".join(words), "a"))
    sets = [{" ".join(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for _, t, _ in rows]
    of = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n) and of[i] != of[j]:
                lo, hi = sorted((of[i], of[j]))
                of = [lo if x == hi else x for x in of]
    want = {i: c for i, c in enumerate(of) if of.count(c) > 1}
    got = C.near_duplicate_clusters(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert len(want) >= 12 and {r.doc_id: r.component for r in got.collect()} == want


def test_codes_fail_closed(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert [(r.k, r.code) for r in G.violations(df, ["k"], {"big": F.col("v") > 3, "null": F.col("v").isNull()}).collect()] == [(1, "null"), (2, "big")]


def test_filters():
    assert G.filters() is None and G.filters(a=None) is None


def test_wilson(spark):
    r = spark.createDataFrame([(0, 0), (3, 100)], "k int, n int").select(E.wilson(F.col("k"), F.col("n")).alias("u"), E.wilson(F.col("k"), F.col("n"), False).alias("l")).collect()
    assert tuple(r[0]) == (1.0, 0.0) and r[1].u == pytest.approx(0.0729, abs=2e-3) and 0 < r[1].l < 0.03
