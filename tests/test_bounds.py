"""What a task or the driver holds does not grow with the table."""

import time
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.operators import governance as G
from quarry.operators.components import connected_components


def test_delta_completeness_deals_rows_over_tasks_that_grow_with_them(spark, monkeypatch):
    monkeypatch.setattr(G, "DEALT", 50, raising=False)
    rows = [(d, None if d % 9 == 0 and i == 1 else i + (d % 4 == 0 and i == 2), None if d % 7 == 0 and i < d % 5 else 1 + (d % 6 == 0 and i > 1)) for d in range(100) for i in range(d % 5 + 1)] * 2
    rows += [(200, 0, 1), (200, 1, 1), (200, 0, 2), (201, 1, 1)]
    chunks = spark.createDataFrame(rows, "doc long, i int, v int")
    out = G.delta_completeness(chunks, ["doc"], "i", "v")
    of, want = defaultdict(list), set()
    for d, i, v in rows:
        of[d].append((i, v))
    for d, xs in of.items():
        version = max((v for i, v in xs if i == 0 and v is not None), default=None)
        own = [i for i, v in xs if v is not None and v == version]
        known = [i for i in own if i is not None]
        if version is None:
            want.add((d, "no_first_chunk"))
        elif len(set(known)) != len(own) or max(known) != len(own) - 1:
            want.add((d, "incomplete"))
        if version is not None and any(v is not None and v != version for _, v in xs):
            want.add((d, "stale_version"))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert out.rdd.getNumPartitions() == len(rows) // 50


def test_components_pass_no_table_through_the_driver(spark):
    def sent():
        jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).resultSize() for i in range(stages.size()))

    i = F.col("id")
    edges = spark.range(60_000).select(i.alias("a"), (i + F.when(i % 10 == 9, 31).otherwise(1)).alias("b"))
    before = sent()
    assert connected_components(edges).count() == 60_004
    time.sleep(1)
    assert sent() - before < 8_000_000
