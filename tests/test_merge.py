import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import corpus as C
from quarry.streaming.merge import MergeTable

SCHEMA = "doc string, i int, text string"


@pytest.mark.parametrize("ratio", [0.1, 1e9])
def test_batches_equal_a_dictionary(spark, tmp_path, ratio):
    """Upserts with repeats and nulls, deletes and cut tails, with and without compaction."""
    rnd = random.Random(2)
    t = MergeTable(spark, str(tmp_path / "t"), ["doc", "i"], SCHEMA, tail="i", ratio=ratio)
    state, want = {}, {}
    for n in range(7):
        up = [(rnd.choice(["a", "b", None]), rnd.choice([0, 1, 2, 3]), rnd.choice(["x", "y", None]) and f"{n}{rnd.random():.3f}") for _ in range(rnd.randrange(0, 6))]
        gone = [(rnd.choice(["a", None, "z"]), rnd.randrange(4)) for _ in range(2)] if n % 2 else []
        tails = [(rnd.choice(["a", "b", None]), 2)] if n % 3 == 2 else []
        tails = [x for x in tails if not any(d == x[0] and i >= 2 for d, i, _ in up)]
        for k in gone:
            want.pop(k, None)
        for d, c in tails:
            want = {k: v for k, v in want.items() if not (k[0] == d and k[1] >= c)}
        best = {}
        for d, i, x in up:
            best[d, i] = max(best.get((d, i), (x is not None, x or "")), (x is not None, x or ""))
        want |= {k: v[1] if v[0] else None for k, v in best.items()}
        df = spark.createDataFrame(up, SCHEMA)
        args = (df, spark.createDataFrame(gone, "doc string, i int"), spark.createDataFrame(tails, "doc string, count int"))
        t.stage(state, n, *args)  # a crash before the pointer: nobody reads it
        state = t.stage(state, n, *args)
        assert {(r.doc, r.i): r.text for r in t.read(state).collect()} == want, n
        some = t.read(state, spark.createDataFrame([("a", 0), (None, 1), ("a", 0)], "doc string, i int")).collect()
        assert {(r.doc, r.i): r.text for r in some} == {k: v for k, v in want.items() if k in (("a", 0), (None, 1))} and len(some) == len({(r.doc, r.i) for r in some})
    assert state["base"].startswith("base-3-") == (ratio > 1)  # the first base, or later ones too


def test_a_batch_writes_its_own_rows(spark, tmp_path):
    t = MergeTable(spark, str(tmp_path / "t"), ["doc"], "doc long, text string")
    big = spark.range(50_000).select(F.col("id").alias("doc"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    state, first = t.stage({}, 0, big), size()
    state = t.stage(state, 1, big.limit(10).withColumn("text", F.lit("new")))
    assert size() - first < first / 100
    assert t.read(state).where("text = 'new'").count() == 10 and t.read(state).count() == 50_000


def test_upsert_and_tail_are_idempotent_for_nulls_and_repeats(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "c"), (1, "d"), (None, "m"), (None, "l"), (3, "e"), (3, None)], "k int, v string")
    once = C.upsert(old, new, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, C.upsert(once, new, ["k"]).collect()))
    assert {(r.k, r.v) for r in once.collect()} == {(1, "d"), (None, "m"), (2, "b"), (3, "e")} and once.count() == 4
    chunks = spark.createDataFrame([(None, 0), (None, 1), (1, 0), (1, 5), (2, 7)], "d int, chunk_index int")
    counts = spark.createDataFrame([(None, 1), (1, 3), (1, 6), (1, 1)], "d int, chunk_count int")
    cut = C.drop_stale_tail(chunks, counts, ["d"])
    assert {tuple(r) for r in cut.collect()} == {(None, 0), (1, 0), (2, 7)} and cut.count() == C.drop_stale_tail(cut, counts, ["d"]).count() == 3


def test_seen_runs_are_committed_without_rewriting(spark, tmp_path, monkeypatch):
    from quarry.operators.agreement import SeenStore

    monkeypatch.setattr(SeenStore, "MOST", 3)
    s = SeenStore(spark, str(tmp_path / "s"))
    rows = lambda *r: spark.createDataFrame(list(r), SeenStore.SCHEMA)
    runs = [[(1, "success", 1, "a", 1), (None, "success", 1, "n", 1)], [(1, "incomplete", None, None, 2), (2, "incomplete", None, None, 2)], [(1, "success", 3, "c", 3)], [(1, "incomplete", None, None, 4)]]
    for i, r in enumerate(runs):
        s.stage(f"r{i}", rows(*r))
        size = len(list((tmp_path / "s").rglob("*.parquet")))
        s.commit(f"r{i}")
        s.stage(f"r{i}", rows((9, "success", 9, "z", 9)))  # a repeat after the commit
        s.commit(f"r{i}")
        assert (len(list((tmp_path / "s").rglob("*.parquet"))) > size) == (i == 2)  # only the third writes a base
    assert {tuple(r) for r in s.read().collect()} == {(1, "incomplete", 3, "c", 4), (2, "incomplete", None, None, 2), (None, "success", 1, "n", 1)}
    s.stage("r9", rows((7, "success", 7, "q", 7)))
    s.rollback("r9")
    with pytest.raises(ValueError):
        s.rollback("r0")
    assert s.read().where("key = 7").count() == 0
