import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import selection
from quarry.operators.selection import find_cuts, within_cut


@pytest.fixture
def narrow(monkeypatch):
    """Small limits, so that small groups are narrowed in rounds."""
    monkeypatch.setattr(selection, "BUCKETS", 4)
    monkeypatch.setattr(selection, "LAST", 3)


def brute(rows, goal):
    total, cut, nxt = 0, None, None
    for k, t, w in sorted(rows):
        if total + w > goal:
            nxt = k
            break
        total, cut = total + w, (k, t)
    return total, cut, nxt


@pytest.mark.parametrize("keys", ["double", "ties", "long"])
def test_cuts_equal_a_sorted_walk(spark, narrow, keys):
    rnd = random.Random(3)
    make = {"double": lambda: rnd.choice([1e300, 1.0, -1e308, 1e308]) * rnd.random(), "ties": lambda: float(rnd.choice([1, 1, 1, 2, 7])), "long": lambda: rnd.choice([2**62, -(2**62), 2**53]) + rnd.randrange(30)}[keys]
    rows = [(g, make(), i, rnd.randrange(0, 9)) for g in ("a", None, "c") for i in range(80 if g == "a" else 11)]
    kind = "long" if keys == "long" else "double"
    df = spark.createDataFrame(rows, f"g string, k {kind}, t long, w long")
    goals = [(g, s, x) for g in ("a", None, "c", "none") for s, x in enumerate((0, 5, 30, 200, 10_000))]
    got = {(r.g, r.slot): r for r in find_cuts(df, ["g"], "k", "w", spark.createDataFrame(goals, "g string, slot int, goal long"), "t").collect()}
    for g, s, x in goals[:15]:
        total, cut, nxt = brute([r[1:] for r in rows if r[0] == g], x)
        r = got[g, s]
        assert (r.taken, r.next_key) == (total, nxt), (g, s)
        if cut and not r.everything:
            assert sum(w for q, k, t, w in rows if q == g and (k < r.cut_key or (r.cut_tie is not None and k == r.cut_key and t <= r.cut_tie))) == total
    assert len(got) == 15


def test_kth_value_without_tie_and_null_keys(spark, narrow):
    df = spark.createDataFrame([(1, 5.0), (1, None), (1, float("nan"))] + [(1, float(i % 4)) for i in range(40)], "g int, k double")
    goals = spark.createDataFrame([(1, i, i) for i in range(41)], "g int, slot int, goal long")
    got = {r.slot: r.next_key for r in find_cuts(df, ["g"], "k", None, goals).collect()}
    values = sorted([5.0] + [float(i % 4) for i in range(40)])
    assert [got[i] for i in range(41)] == values


def test_within_cut_marks_the_prefix(spark, narrow):
    df = spark.createDataFrame([(1, float(i % 5), i, 2) for i in range(50)], "g int, k double, t long, w long")
    cut = find_cuts(df, ["g"], "k", "w", spark.createDataFrame([(1, 0, 31)], "g int, slot int, goal long"), "t")
    n = df.join(cut, "g").where(within_cut(F.col("k"), F.col("t"))).count()
    assert n == 15
    assert find_cuts(df.limit(0), ["g"], "k", "w", spark.createDataFrame([(1, 0, 31)], "g int, slot int, goal long"), "t").count() == 0


def test_percentiles_of_a_huge_group_without_a_window(spark, narrow):
    import numpy as np

    from quarry.operators import evaluation as E

    rng = np.random.default_rng(0)
    rows = [(g, None if i % 11 == 0 else float(v)) for g, n in (("a", 97), (None, 40), ("b", 1)) for i, v in enumerate(rng.choice([1.0, 2.5, 7.0, 1e9], n) * rng.random(n).round(1))] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in E.percentiles(df, "v", "g").collect()}
    for g in ("a", None):
        v = np.array([x for q, x in rows if q == g and x is not None])
        assert got[g].p50 == pytest.approx(np.percentile(v, 50), abs=1e-6) and got[g].p95 == pytest.approx(np.percentile(v, 95), abs=1e-6)
        assert got[g].p95_disc == sorted(v)[int(np.ceil(0.95 * len(v))) - 1]
    assert got["none"].p50 is None and got["b"].p50 is None  # its one value is null
    t = {r.g: r.value for r in E.rank_percentile(df, "v", "g", 95, "truncate").collect()}
    v = sorted(x for q, x in rows if q == "a" and x is not None)
    assert t["a"] == v[min(len(v) - 1, int(95 / 100 * len(v)))] and "none" not in t
    plan = E.percentiles(df, "v", "g")._jdf.queryExecution().toString()
    assert "percentile(" not in plan


def test_quotas_take_the_first_by_hash(spark, narrow):
    import hashlib

    from quarry.operators.selection import first_by_hash

    rows = [(i, "big" if i % 9 else None) for i in range(200)] + [(5, "big")] * 30
    quotas = spark.createDataFrame([("big", 50), (None, 7), ("absent", 3)], "g string, quota long")
    got = sorted(r.doc_id for r in first_by_hash(spark.createDataFrame(rows, "doc_id long, g string"), "g", quotas).where("g is not null").collect())
    order = sorted((hashlib.sha256(f"seed{i}".encode()).hexdigest(), i) for i, g in rows if g)
    if order[49][1] != 5:
        assert got == sorted(i for _, i in order[:50])
    assert first_by_hash(spark.createDataFrame(rows, "doc_id long, g string"), "g", quotas).where("g is null").count() == 7


def test_replicates_of_many_clusters_are_rows(spark):
    from quarry.operators import evaluation as E

    df = spark.range(20_000).selectExpr("'m' metric", "id cluster", "cast(id % 2 as double) value", "cast(id % 2 as double) a", "0.5D + (id % 5) / 1000D b")
    r = E.bootstrap_ci(df, 200).first()
    assert 0.49 < r.lo < 0.5 < r.hi < 0.51 and r.clusters == 20_000
    assert sorted(map(tuple, E.bootstrap_ci(df.repartition(7), 200).collect())) == [tuple(r)]
    p = E.permutation_p(df, 300).first()
    assert 0.3 < p.p <= 1 and E.permutation_p(df.withColumn("b", F.lit(0.4)), 300).first().p == pytest.approx(1 / 301)
