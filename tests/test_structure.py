import json

import pytest
from pyspark.sql import functions as F

from quarry.functions.masking import mask, unmask
from quarry.operators import lint as L
from quarry.operators import structure as U
from quarry.sinks import publish as W

BODY = "# Head\nthe start\nთავი I general\nმუხლი 1. first\n1. one\nა) letter\n2. two\nმუხლი 2. second\nfree text\n1. again\n"


def test_context_of_spans(spark):
    docs = spark.createDataFrame([(1, BODY), (2, None)], "doc_id long, text string")
    m = U.markers(docs)
    assert [(r.kind, r.id) for r in m.orderBy("start").collect()] == [("heading", "Head"), ("chapter", "I"), ("article", "1"), ("clause", "1"), ("subclause", "ა"), ("clause", "2"), ("article", "2"), ("clause", "1")]
    at = {w: BODY.index(w) for w in ("the start", "letter", "two", "free")}
    spans = [(1, i, p, p + 4) for i, p in enumerate(at.values())]
    got = {r.span_id: r for r in U.context(spark.createDataFrame(spans, "doc_id long, span_id int, start int, end int"), m).collect()}
    assert got[0].article is None and got[0].parent is None
    assert (got[1].chapter, got[1].article, got[1].clause, got[1].subclause, got[1].parent) == ("I", "1", "1", "ა", "article:1")
    assert (got[2].clause, got[2].subclause) == ("2", None)
    assert (got[3].article, got[3].clause) == ("2", None)  # the clause of article 1 does not reach here
    s = {r.doc_id: (r.articles, r.primary) for r in U.structure_summary(docs.na.fill("")).collect()}
    assert s == {1: (2, "article"), 2: (0, "flat")}


def test_masking_round_trip():
    t = "see 240140000.05.001.102038 and №71 of 2020-01-02, AR111390"
    m, kept = mask(t)
    assert unmask(m, kept) == t and len(kept) == 4 and "240140000" not in m
    for bad in (m.replace("⟦0⟧", ""), m + "⟦1⟧", m.replace("⟦0⟧", "⟦9⟧")):
        with pytest.raises(ValueError):
            unmask(bad, kept)


def test_publish_is_whole_and_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert W.publish({"t": df}, str(tmp_path), "g", {"t": ["k"]})["t"]["rows"] == 2
    with pytest.raises(FileExistsError):
        W.publish({"t": df}, str(tmp_path), "g")
    with pytest.raises(ValueError):
        W.publish({"t": df.union(df)}, str(tmp_path), "h", {"t": ["k"]})
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".staging") or p.name == "h"]
    W.write_jsonl(df, str(tmp_path / "j"), ["k"])
    lines = [x for p in sorted((tmp_path / "j").glob("part*")) for x in p.read_text().splitlines()]
    assert lines == ['{"k":1,"v":"a"}', '{"k":2,"v":"b"}']
    W.append_log(df.withColumn("s", F.lit(0.123456)), str(tmp_path / "log"), ["s"])
    W.append_log(df.withColumn("s", F.lit(0.5)), str(tmp_path / "log"), ["s"])
    rows = [json.loads(x) for p in (tmp_path / "log").glob("part*") for x in p.read_text().splitlines()]
    assert len(rows) == 4 and {r["s"] for r in rows} == {0.1235, 0.5}
    W.replace_partitions(df, str(tmp_path / "p"), "k")
    W.replace_partitions(df.where("k = 1").withColumn("v", F.lit("z")), str(tmp_path / "p"), "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [(1, "z"), (2, "b")]


def test_exactly_one(spark):
    df = spark.createDataFrame([(True, False), (True, True), (None, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(L.exactly_one([F.col("a"), F.col("b")])).collect()] == [True, False, False]


def test_whole_tables_are_read(spark, sf):
    from quarry.plans.registry import QUERIES
    from quarry.session import table

    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    got = lambda name, key: {r[0] for r in QUERIES[name](spark, sf).select(key).collect()}
    assert got("date_windows", "o_orderkey") == {r[0] for r in orders.select("o_orderkey").collect()}
    assert got("final_reviews", "item") == {r[0] // 4 for r in events.select("event_id").collect()}
    kinds, splits = {}, {}
    for r in events.select("user_id", "event_id", "event_type").collect():
        kinds.setdefault(r.user_id * 40 + r.event_id % 40, set()).add(r.event_type)
        splits.setdefault(r.user_id, set()).add(r.event_id % 3 if r.event_id % 7 == 0 else r.user_id % 3)
    assert got("missing_kinds", "visit") == {k for k, v in kinds.items() if {"view", "click", "error"} - v}
    assert got("split_leakage", "user_id") == {k for k, v in splits.items() if len(v) > 1}
