import random

import pytest

from quarry.operators import corpus
from quarry.operators.corpus import asof_join


@pytest.mark.parametrize("hot", [10, 1_000_000])
def test_against_a_plain_search(spark, monkeypatch, hot):
    monkeypatch.setattr(corpus, "HOT_ROWS", hot)
    rnd = random.Random(1)
    key = lambda: 1 if rnd.random() < 0.5 else rnd.choice([2, 3, 4, None])  # noqa: E731  half of the rows have one key
    left = [(i, key(), rnd.randrange(400)) for i in range(300)]
    right = [(key(), rnd.randrange(50, 350), rnd.choice([None, *range(9)])) for _ in range(200)]
    out = asof_join(spark.createDataFrame(left, "i int, k int, t int"), spark.createDataFrame(right, "k int, t int, v int"), "k", "t", "v", parts=8).collect()
    want = {i: max(((t2, v) for k2, t2, v in right if k2 == k and k is not None and t2 <= t and v is not None), default=(0, None))[1] for i, k, t in left}
    assert {r.i: r.asof_v for r in out} == want and len(out) == len(left)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k int, t int, v int")
    some = spark.createDataFrame([(1, 5, 2)], "k int, t int, v int")
    assert asof_join(some.drop("v"), none, "k", "t", "v").collect()[0].asof_v is None and asof_join(none.drop("v"), some, "k", "t", "v").count() == 0
