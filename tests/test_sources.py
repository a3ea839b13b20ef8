import datetime
import uuid

from pyspark.sql import functions as F

from quarry.functions.chunking import chunk_documents
from quarry.functions.register import register
from quarry.operators import index as I
from quarry.plans.engine import Engine
from quarry.sources.canonical import Spec, canonicalize, union_sources


def test_canonical_documents(spark):
    a = spark.createDataFrame([("x", "", "T", "2020-04-27", "text", "yes", "A"), ("", None, None, "31-02-2020", None, None, "")], "slug string, alt string, name string, day string, md string, done string, court string")
    b = spark.createDataFrame([(7, "body", "Repealed")], "num int, body string, state string")
    sa = Spec("one", ("slug", "alt"), {"title": ("missing", "name"), "date": ("day",), "body": ("md",), "content_complete": ("done",)}, {"document_type": "decision"}, False, ("court",))
    sb = Spec("two", ("num",), {"status": ("state",)})
    rows = union_sources(canonicalize(a, sa), canonicalize(b, sb)).collect()
    x, y, z = rows
    assert (x.document_id, x.title, x.date, x.document_type, x.content_complete, x.promoted, x.issue) == ("x", "T", datetime.date(2020, 4, 27), "decision", True, {"court": "A"}, None)
    assert (y.document_id, y.date, y.issue, y.promoted) == (None, None, "no_identity", {})
    assert (z.document_id, z.status, z.content_complete) == ("7", "repealed", True) and z.version_id.startswith("derived:")
    again = canonicalize(b, sb).first()
    assert again.version_id == z.version_id


def test_sql_functions(spark):
    register(spark)
    assert spark.sql("select nfc('é') as x").first().x == "é"
    assert spark.sql("select html_to_markdown('<h1>A</h1>', '') as x").first().x == "# A"
    rows = spark.sql("select d.id, c.chunk_index, c.text from (select 1 as id, 'a b c d e f' as t) d, lateral chunk_document(d.t, 3, 0, 1) c order by 2").collect()
    assert [r.text for r in rows] == ["a b c", "d e f"]


def test_payloads(spark):
    docs = spark.createDataFrame([(1, "s", "one two three " * 300)], "doc_id long, source string, text string")
    p = I.payloads(docs.drop("text"), chunk_documents(docs))
    r = p.orderBy("chunk_index").first()
    assert r.point_id == str(uuid.uuid5(uuid.NAMESPACE_URL, "s:1:0")) and r.chunk_count == p.count() == 2 or p.count() > 1
    assert I.payload_violations(p, docs).count() == 0
    bad = p.withColumn("char_start", F.col("char_start") + 1).withColumn("passage_hash", F.lit("0"))
    assert {r.code for r in I.payload_violations(bad, docs).collect()} == {"slice", "hash"}


def test_engine(spark):
    docs = spark.createDataFrame([(1, "red fox", "a", True), (2, "red dog", "b", True), (3, "red fox red", "a", False), (4, "blue", "b", None)], "doc_id long, text string, source string, content_complete boolean")
    q = spark.createDataFrame([(1, "red fox"), (2, "green")], "qid long, text string")
    e = Engine(docs)
    got = [(r.qid, r.doc_id) for r in e.search(q, 2, "bm25", source="a").orderBy("rank").collect()]
    assert sorted(got) == [(1, 1), (1, 3)]
    hits = e.accurate(q, exact=spark.createDataFrame([(1, 2), (1, 3)], "qid long, doc_id long"), k=5)
    rows = {r.doc_id: r.branch for r in hits.collect()}
    assert rows == {1: 1, 2: 0}
    assert [(r.qid, r.reason) for r in e.abstentions(q, hits).collect()] == [(2, "no_evidence")]
    assert "".join(r.piece for r in e.document(1).collect()) == "red fox"
    assert {r.source: r.n for r in e.status().collect()} == {"a": 2, "b": 2, None: 4}
    assert e.browse([F.col("doc_id")], 1, 2).count() == 2 and e.lookup(source="b").count() == 2
    pinned = spark.createDataFrame([(1, 4, 1)], "qid long, doc_id long, rank int")
    first = e.search(q, 2, "hybrid", pinned=pinned).where("rank = 1").collect()
    assert [(r.qid, r.doc_id) for r in first] == [(1, 4)]
