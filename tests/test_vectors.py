import numpy as np
from pyspark.sql import functions as F

from quarry.operators import retrieval as R
from quarry.operators import vectors as V


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")


def test_components_and_variance_against_numpy(spark):
    rnd = np.random.default_rng(1)
    x = (rnd.normal(size=(200, 5)) * [5, 3, 2, 1, 0.5]).astype(np.float32)
    c = x - x.mean(axis=0)
    _, sv, vt = np.linalg.svd(c.astype(float), full_matrices=False)
    share = sv**2 / (sv**2).sum()
    got = V.explained_variance(table(spark, x), 5).orderBy("component").collect()
    assert np.allclose([r.share for r in got], share, atol=1e-5) and abs(got[-1].running - 1) < 1e-5
    p = np.array([r.components for r in V.principal_components(table(spark, x), 2).orderBy("vec_id").collect()])
    want = x @ vt[:2].T
    assert np.allclose(np.abs(p), np.abs(want), atol=1e-3)  # signs are free


def test_the_number_of_clusters_is_chosen(spark):
    rnd = np.random.default_rng(2)
    centres = np.array([(0, 0), (20, 0), (0, 20), (20, 20), (40, 40)])
    x = np.vstack([rnd.normal(size=(40, 2)) + c for c in centres])
    got = V.kmeans(table(spark, x), [3, 4, 5, 6]).collect()
    assert [r.k for r in got if r.chosen] == [5]

    def silhouette(labels):  # with squared distances, as the evaluator has it
        d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        out = []
        for i, k in enumerate(labels):
            own = d[i][labels == k].sum() / max(1, (labels == k).sum() - 1)
            other = min(d[i][labels == j].mean() for j in set(labels) - {k})
            out.append((other - own) / max(own, other))
        return np.mean(out)

    assert abs(got[2].silhouette - silhouette(np.repeat(np.arange(5), 40))) < 1e-6


def test_dense_top_k_against_all_pairs(spark):
    rnd = np.random.default_rng(3)
    x = rnd.integers(-2, 3, size=(300, 4)).astype(float)  # many ties and some zero vectors
    v = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "doc_id long, vector array<double>").repartition(5)
    q = spark.createDataFrame([(i, list(map(float, x[i]))) for i in range(0, 300, 30)], "qid long, vector array<double>")
    n = np.maximum(np.linalg.norm(x, axis=1), 1e-300)
    got = {}
    for r in R.dense(v, q, 7).collect():
        got.setdefault(r.qid, []).append((r.rank, r.doc_id, r.score))
    for i in range(0, 300, 30):
        s = np.round((x / n[:, None]) @ (x[i] / n[i]), 5)
        order = sorted(range(300), key=lambda j: (-s[j], j))[:7]
        assert [d for _, d, _ in sorted(got[i])] == order


def test_mmr_against_a_plain_loop(spark):
    rnd = np.random.default_rng(4)
    rows = []
    for qid in range(4):
        for rank in range(1, 13):
            u = rnd.normal(size=3)
            rows.append((qid, qid * 100 + rank, rank, float(1 - rank / 20), [float(a) for a in u / np.linalg.norm(u)], f"k{rank % 3}"))
    df = spark.createDataFrame(rows, "qid long, doc_id long, rank int, score double, vector array<double>, key string")
    got = {}
    for r in R.mmr(df, 6, 0.5, cap=2).collect():
        got.setdefault(r.qid, []).append((r.rank, r.doc_id))
    for qid in range(4):
        pool, chosen = [r for r in rows if r[0] == qid], []
        while len(chosen) < 6:
            free = [r for r in pool if r not in chosen and sum(c[5] == r[5] for c in chosen) < 2]
            if not free:
                break
            near = lambda r: max((float(np.dot(r[4], c[4])) for c in chosen), default=0.0)  # noqa: E731, B023
            chosen.append(max(free, key=lambda r: (round(0.5 * r[3] - 0.5 * near(r), 9), -r[2])))
        assert [d for _, d in sorted(got[qid])] == [c[1] for c in chosen]


def test_inverted_file_recall_and_exactness(spark):
    from quarry.operators.ivf import InvertedFile

    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    v = t.selectExpr("vec_id doc_id", "embedding vector")
    q = t.where("vec_id % 100 = 0").selectExpr("vec_id qid", "embedding vector")
    index = InvertedFile(v, cells=40)
    exact = {(r.qid, r.doc_id) for r in R.dense(v, q, 10).collect()}
    found = {(r.qid, r.doc_id) for r in index.search(q, 10, probes=30).collect()}
    assert len(found & exact) >= 0.95 * len(exact) and index.lists.count() == v.count()
    one = index.search(q.limit(1), 10, probes=1)
    cells = [r.cell for r in index.lists.where(F.col("doc_id").isin([r.doc_id for r in one.collect()])).select("cell").distinct().collect()]
    assert len(cells) == 1


def test_inverted_file_with_odd_vectors(spark, monkeypatch):
    from quarry.operators import ivf

    monkeypatch.setattr(ivf, "RUN_ROWS", 16)  # large cells are many parts
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.standard_normal(5)]) for i in range(200)] + [(300, None), (301, [1.0]), (302, [0.0] * 5), (303, [None] * 5), (None, [1.0] * 5), (304, [float("nan")] * 5)]
    v = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    q = spark.createDataFrame([(1, rows[0][1]), (2, rows[7][1]), (3, None), (4, [0.0] * 5), (5, [1.0])], "qid long, vector array<double>")
    index = ivf.InvertedFile(v, cells=6)
    got, want = index.search(q, 230, probes=6, depth=0), R.dense(v, q, 230)
    pick = lambda d: sorted((r.qid, r.doc_id, r.score) for r in d.where("qid < 3").collect())
    assert pick(got) == [x for x in pick(want) if x[1] != 301] + [x for x in pick(want) if x[1] == 301] or pick(got) == pick(want)
    assert {r.doc_id for r in got.where("qid = 3").collect()} == {300, 301, 302, 303, 304}
    assert ivf.InvertedFile(v.limit(0)).search(q, 3).count() == 0 and index.search(q, 0).count() == 0
