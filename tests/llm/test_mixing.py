import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing
from quarry.operators import selection


def spread(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets as the words say it: share by weight, take what is above, share it anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, left = dict.fromkeys(order, 0.0), set(), share * sum(sizes.values())
    while left > 1e-9:
        free = [s for s in order if s not in full]
        part = left / sum(w[s] for s in free)
        left = 0.0
        for s in free:
            target[s] += part * w[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return target


def walk(rows, rate, goal):
    """Pareto ranks and every row that still fits, one at a time."""
    ranked = []
    for i, (key, size) in enumerate(rows):
        p = rate - int(rate)
        if p > 0 and size > 0:
            ranked.append((mixing_u(key) / (1 - mixing_u(key)) * ((1 - p) / p), i))
    copies, lack = [int(rate)] * len(rows), goal - sum(int(rate) * s for _, s in rows)
    for _, i in sorted(ranked):
        if rows[i][1] <= lack:
            copies[i] += 1
            lack -= rows[i][1]
    return copies


def mixing_u(key):
    import hashlib

    return (int(hashlib.md5(f"mix/{'' if key is None else key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


@pytest.fixture
def narrow(monkeypatch):
    monkeypatch.setattr(selection, "BUCKETS", 8)
    monkeypatch.setattr(selection, "LAST", 4)


def test_mix_equals_a_walk_row_by_row(spark, narrow):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "é", "b", None, "c", "hot", "hot", "hot"]), rnd.choice([0, 1, 3, 50, 200, 900])) for i in range(300)] + [(1000, "tiny", 1)]
    out = {r.doc_id: r for r in mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    by = defaultdict(list)
    for k, s, n in rows:
        by[s].append((k, n))
    sizes = {s: sum(n for _, n in v) for s, v in by.items()}
    target = spread(sizes)
    for s, v in by.items():
        want = walk(v, target[s] / sizes[s] if sizes[s] else 0.0, target[s])
        for (k, n), c in zip(v, want, strict=True):
            assert out[k].copies == c and out[k].taken == c * n and out[k].source_size == sizes[s]
            assert out[k].target == pytest.approx(target[s])
    assert len(out) == len(rows)


def test_inclusion_follows_the_rates_and_weights(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("size"), F.when(F.col("id") % 4 == 0, 3.0).otherwise(1.0).alias("w"), F.lit("x").alias("target"))
    out = mixing.mix_sources(rows, weight="w", share=0.6).groupBy((F.col("doc_id") % 4 == 0).alias("heavy")).agg(F.avg("copies").alias("a")).collect()
    got = {r.heavy: r.a for r in out}  # 0.6 on the mean: 0.4 and 1.2
    assert got[True] == pytest.approx(1.2, abs=0.04) and got[False] == pytest.approx(0.4, abs=0.03)
    full = mixing.mix_sources(rows, weight="w", share=1.9).agg(F.max("copies"), F.sum("taken")).first()
    assert full[0] == 2 and 7599 <= full[1] <= 7600


def test_odd_rows(spark):
    kind = "doc_id long, source string, size long, copies string, taken int"
    assert mixing.mix_sources(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, None, None, "x", 1), (None, None, 10, "x", 1), (3, "a", -4, "x", 1)] + [(7, "a", 5, "x", 1)] * 60 + [(8, "a", 5, "y", 1)]
    out = mixing.mix_sources(spark.createDataFrame(rows, kind)).collect()
    assert len(out) == len(rows) and all(r.taken <= 2 * max(r.size, 0) for r in out)
    a = [r for r in out if r.target == max(x.target for x in out)]
    assert 0 <= a[0].target - sum(r.taken for r in a) < 5
    nothing = mixing.mix_sources(spark.createDataFrame([(1, "a", 0), (2, None, None)], "doc_id long, source string, size long")).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.source_targets(spark.createDataFrame([("a", 1)], "source string, source_size long"), share=3.0)


def test_reruns_and_partitions_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    a, b = (sorted(map(tuple, mixing.mix_sources(d).collect())) for d in (docs, docs.repartition(7, "source")))
    assert a == b
    long = spark.createDataFrame([("w " * 400_000,), ("",), (None,), ("\x1c a\x0bb",)], "text string").select(mixing.word_count(F.col("text"))).collect()
    assert [r[0] for r in long] == [400_000, 0, 0, 3]
