import random

import numpy as np
import pytest

from quarry.functions.records import match_alias, normal_alias
from quarry.operators import setjoin
from quarry.operators.agreement import near_pool
from quarry.operators.retrieval import dense
from quarry.operators.review import similar_questions
from quarry.operators.setjoin import set_join


def likeness(x, y):
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("threshold", [0.0, 0.12, 0.5, 2 / 3, 0.8, 0.999])
def test_equals_all_pairs(spark, threshold):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    sets = [(i, sorted({*rnd.sample(words, rnd.randrange(0, 8)), *(["the"] if i % 5 else [])})) for i in range(60)]
    sets += [(100, sets[3][1]), (None, ["the", "w1"])]
    df = spark.createDataFrame(sets, "id int, s array<string>")
    got = {(r.a, r.b): r.likeness for r in set_join(df, None, threshold).collect()}
    fine = [(i, set(s)) for i, s in sets if s and i is not None]
    want = {(i, j): likeness(x, y) for i, x in fine for j, y in fine if i < j and likeness(x, y) > threshold}
    assert got == pytest.approx(want)
    left, right = df.where("id % 2 = 0"), df.where("id % 3 = 0")
    both = {(r.a, r.b) for r in set_join(left, right, threshold).collect()}
    assert both == {(i, j) for i, x in fine for j, y in fine if i % 2 == 0 and j % 3 == 0 and likeness(x, y) > threshold}
    assert set_join(df.limit(0), None, threshold).count() == 0


def test_a_token_of_all_questions_makes_no_quadratic_join(spark):
    rows = spark.range(2000).selectExpr("cast(id as int) qid", "concat('the a', id, ' b', id, ' c', id % 1000) text")
    out = similar_questions(rows, 0.5)
    assert out.count() == 0 and similar_questions(rows, 0.3).count() == 1000
    assert near_pool(rows.where("qid < 10"), rows.where("qid >= 1000"), 0.3).count() == 10
    few = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "the")], "qid int, text string")
    assert {(r.a, r.b) for r in similar_questions(few, 0.4).collect()} == {(1, 3), (2, 3)}


def test_alias_of_any_table_and_text(spark):
    rnd = random.Random(1)
    aliases = [(f"law {i} of {'x' * (i % 40)}", i) for i in range(400)] + [("a", 1000), ("Ünï «quoted»", 1001), ("dup", 5), ("DUP", 3), (None, 1), ("", 2)]
    texts = [f"{rnd.choice('abc ')}law {rnd.randrange(500)} of {'x' * rnd.randrange(45)}" for _ in range(80)] + [None, "", "ünï quoted", "dup", "a", "pad " * 700 + "law 39 of " + "x" * 39, "b"]
    q = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "qid int, text string, a string")
    got = {r.qid: (r.alias, r.target) for r in match_alias(q, spark.createDataFrame(aliases, "alias string, target int"), coverage=0.0).collect()}
    plain = {r.i: r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate([a for a, _ in aliases] + texts)], "i int, t string").select("i", normal_alias("t").alias("n")).collect()}
    known = {}
    for i, (_, t) in enumerate(aliases):
        if plain[i]:
            known[plain[i]] = min(known.get(plain[i], str(t)), str(t))
    for i in range(len(texts)):
        n = plain[len(aliases) + i]
        held = sorted((a for a in known if n and a in n), key=lambda a: (-len(a), a))
        assert got[i] == ((held[0], known[held[0]]) if held else (None, None)), texts[i]


def test_dense_with_null_ragged_and_zero_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [-1.0, 0.0]), (8, []), (None, [1.0, 0.0]), (9, [3.0, 4.0])], "doc_id long, vector array<float>")
    q = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, [5.0]), (4, [0.0, 0.0]), (None, [1.0, 0.0])], "qid long, vector array<float>")
    got = {}
    for r in dense(v, q, 20).collect():
        got.setdefault(r.qid, []).append((r.doc_id, r.score))
    assert got[1] == [(1, 1.0), (9, 0.6), (2, 0.0), (3, 0.0), (4, 0.0), (5, 0.0), (6, 0.0), (8, 0.0), (7, -1.0)]
    assert got[3][0] == (3, 1.0) and {s for _, s in got[3][1:]} == {0.0} and {s for _, s in got[2] + got[4]} == {0.0} and set(got) == {1, 2, 3, 4}
    assert dense(v, q, 0).count() == 0 and dense(v, q.limit(0), 3).count() == 0


@pytest.mark.parametrize("threshold", [0.0, 0.12, 0.5, 0.8])
def test_blocks_equal_all_pairs(spark, monkeypatch, threshold):
    monkeypatch.setattr(setjoin, "MEETINGS", 0)
    monkeypatch.setattr(setjoin, "BLOCK", 25)
    monkeypatch.setattr(setjoin, "TILE", 64)
    monkeypatch.setattr(setjoin, "COMMON", 64)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    sets = [(f"{i:03}", sorted({*rnd.sample(words[: rnd.choice([20, 150])], rnd.randrange(0, 20)), *(["the"] if i % 5 else [])})) for i in range(150)] + [(None, ["the"])]
    df = spark.createDataFrame(sets, "id string, s array<string>")
    fine = [(i, set(s)) for i, s in sets if s and i is not None]
    got = [(r.a, r.b, r.likeness) for r in set_join(df, None, threshold).collect()]
    want = {(i, j): likeness(x, y) for i, x in fine for j, y in fine if i < j and likeness(x, y) > threshold}
    assert {(a, b): x for a, b, x in got} == pytest.approx(want) and len(got) == len(want) > 0
    left, right = df.where("id < '080'"), df.where("id >= '070'").selectExpr("cast(id as int) id", "s")
    got = [(r.a, r.b) for r in set_join(left, right, threshold).collect()]
    assert sorted(got) == sorted((i, int(j)) for i, x in fine for j, y in fine if i < "080" and j >= "070" and likeness(x, y) > threshold)


def test_a_low_threshold_shuffles_no_candidates(spark):
    rows = spark.range(600).selectExpr("cast(id as int) id", "transform(sequence(0, 39), x -> concat('w', pmod(hash(id, x), 300))) s").selectExpr("id", "array_distinct(s) s")
    plan = set_join(rows.where("id < 300"), rows.where("id >= 300"), 0.12)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "HashAggregate" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("meetings", [0, 10**9])
def test_sets_with_one_id_are_compared_each_for_itself(spark, monkeypatch, meetings):
    monkeypatch.setattr(setjoin, "MEETINGS", meetings)
    left = spark.createDataFrame([(1, ["a", "b"]), (1, ["c", "d"]), (2, ["e", "f"]), (2, ["e", "f"])], "id int, s array<string>")
    right = spark.createDataFrame([(7, ["a", "b"]), (7, ["c", "d"]), (8, ["a", "b", "c", "d"]), (9, ["e", "f", "g", "h"])], "id int, s array<string>")
    got = sorted(tuple(r) for r in set_join(left, right, 0.4).collect())
    assert got == [(1, 7, 1.0), (1, 7, 1.0), (1, 8, 0.5), (1, 8, 0.5), (2, 9, 0.5), (2, 9, 0.5)]
    assert sorted(tuple(r) for r in set_join(left.unionByName(right), None, 0.4).where("a = 1").collect()) == [(1, 7, 1.0), (1, 7, 1.0), (1, 8, 0.5), (1, 8, 0.5)]


def test_few_blocks_of_bounded_size():
    """Each set is moved once for each block of the other side: sizes are put together into few blocks, and split where one is too large."""
    sizes = [(n, 1000, 1000 * n) for n in range(1, 61)] + [(90, 200_000, 200_000 * 90)]
    places, blocks = setjoin.cut_by_size(sizes)
    assert [n for n, *_ in places] == [n for n, *_ in sizes] and len(blocks) <= 4 * setjoin.GRID
    held = [[0, 0] for _ in blocks]
    for (n, first, parts), (_, count, members) in zip(places, sizes, strict=True):
        for b in range(first, first + parts):
            held[b][0] += count / parts
            held[b][1] += members / parts
            assert blocks[b][0] <= n <= blocks[b][1]
    assert max(r for r, _ in held) <= setjoin.BLOCK and max(m for _, m in held) <= setjoin.MEMBERS


@pytest.mark.parametrize("tile, wide, slab", [(1 << 19, 2048, 1 << 24), (700, 50, 4000), (1, 1, 1)])
@pytest.mark.parametrize("threshold", [0.0, 0.12, 0.6])
def test_rows_of_a_block_equal_all_pairs(monkeypatch, tile, wide, slab, threshold):
    for k, v in (("TILE", tile), ("WIDE", wide), ("SLAB", slab)):
        monkeypatch.setattr(setjoin, k, v)
    rnd = np.random.default_rng(3)

    def side(count, known):
        sets = known + [np.unique(np.minimum(rnd.zipf(1.3, rnd.integers(1, 60)), 5000)) for _ in range(count)]
        return sets, setjoin.Sets(np.array([len(s) for s in sets]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]), np.concatenate(sets))

    a, x = side(70, [])
    b, y = side(90, [s[: -(-len(s) * 3 // 4)] for s in a[::10]])
    got = {(int(i), int(j)): like for p, q, ls in setjoin.alike_rows(x, y, threshold) for i, j, like in zip(p, q, ls, strict=True)}
    want = {(i, j): likeness(set(s), set(t)) for i, s in enumerate(a) for j, t in enumerate(b) if likeness(set(s), set(t)) > threshold}
    assert got == want and want
