"""Queries over structure, lint and sink operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import lint as L
from quarry.operators import structure as U
from quarry.plans.base import Plans
from quarry.session import shared_dir, table
from quarry.sinks import publish as W

plans = Plans()


@plans.add("governing_marker", "WITH m AS (SELECT doc_id, 150 + i * 700 AS at_, 'm' || i AS id FROM (SELECT doc_id, n_chars, unnest(range(0, n_chars // 700 + 1)) AS i FROM documents) WHERE i % 3 <> 1), s AS (SELECT doc_id, j::INT AS span_id, (j * 400)::INT AS start, (j * 400 + 300)::INT AS \"end\" FROM (SELECT doc_id, n_chars, unnest(range(0, n_chars // 400 + 1)) AS j FROM documents)), b AS (SELECT s.*, m.id, m.at_ FROM s ASOF LEFT JOIN m ON s.doc_id = m.doc_id AND s.start >= m.at_), a AS (SELECT s.doc_id, s.span_id, m.id, m.at_ FROM s ASOF LEFT JOIN m ON s.doc_id = m.doc_id AND s.start <= m.at_) SELECT b.doc_id, b.span_id, b.start, b.\"end\", coalesce(b.id, CASE WHEN a.at_ < b.\"end\" THEN a.id END) AS id, coalesce(b.at_, CASE WHEN a.at_ < b.\"end\" THEN a.at_ END)::INT AS at FROM b JOIN a USING (doc_id, span_id)")
def governing_marker(s, d):
    docs = table(s, d, "documents").select("doc_id", "n_chars")
    each = lambda step, name: docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("n_chars") / step).cast("int"))).alias(name))
    m = each(700, "i").where("i % 3 <> 1").select("doc_id", (F.col("i") * 700 + 150).alias("start"), F.concat(F.lit("m"), F.col("i").cast("string")).alias("id"))
    sp = each(400, "span_id").select("doc_id", "span_id", (F.col("span_id") * 400).alias("start"), (F.col("span_id") * 400 + 300).alias("end"))
    return U.governing(sp, m)


@plans.add("contiguous_windows", "WITH w AS (SELECT o_custkey AS k, o_orderdate::DATE AS start, o_orderdate::DATE + (o_orderkey % 400)::INT - 20 AS e FROM orders), p AS (SELECT *, lag(e) OVER (PARTITION BY k ORDER BY start, e) AS p FROM w) SELECT k, start, 'reversed' AS code FROM p WHERE e < start UNION ALL SELECT k, start, 'overlap' FROM p WHERE start <= p.p UNION ALL SELECT k, start, 'gap' FROM p WHERE start > p.p + 1")
def contiguous_windows(s, d):
    o = table(s, d, "orders")
    start = F.col("o_orderdate").cast("date")
    return L.contiguous_windows(o.select(F.col("o_custkey").alias("k"), start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 400 - 20).cast("int")).alias("end")), "k")


@plans.add("final_reviews", "WITH r AS (SELECT event_id // 4 AS item, user_id AS reviewer, CASE WHEN event_id % 4 = 2 OR event_id % 11 = 3 THEN 'observer' WHEN event_id % 4 = 3 THEN 'adjudicator' ELSE 'reviewer' END AS role, event_type AS verdict FROM events), g AS (SELECT item, count(DISTINCT CASE WHEN role = 'reviewer' THEN reviewer END) AS n, min(CASE WHEN role = 'reviewer' THEN verdict END) AS lo, max(CASE WHEN role = 'reviewer' THEN verdict END) AS hi, max(CASE WHEN role = 'adjudicator' THEN verdict END) AS adj FROM r GROUP BY item) SELECT item, CASE WHEN n >= 2 AND lo = hi THEN lo ELSE adj END AS verdict, CASE WHEN n >= 2 AND lo = hi THEN 'agreed' WHEN adj IS NOT NULL THEN 'adjudicated' ELSE 'unresolved' END AS how FROM g")
def final_reviews(s, d):
    e = table(s, d, "events")
    i = F.col("event_id")
    return L.final_reviews(e.select(F.floor(i / 4).alias("item"), F.col("user_id").alias("reviewer"), F.when((i % 4 == 2) | (i % 11 == 3), "observer").when(i % 4 == 3, "adjudicator").otherwise("reviewer").alias("role"), F.col("event_type").alias("verdict")))


@plans.add("set_difference", "WITH a AS (SELECT source, lang FROM documents WHERE doc_id % 2 = 0), b AS (SELECT source, lang FROM documents WHERE doc_id % 2 = 1) SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)")
def set_difference(s, d):
    docs = table(s, d, "documents")
    return L.set_difference(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), ["source", "lang"])


@plans.add("issue_report", "SELECT lang, total, doc_id AS example, n FROM (SELECT lang, doc_id, count(*) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY doc_id)::INT AS n FROM documents WHERE n_chars > 2000) WHERE n <= 3")
def issue_report(s, d):
    return L.issue_report(table(s, d, "documents").where("n_chars > 2000"), "lang", "doc_id")


@plans.add("expand_references", "WITH c AS (SELECT l_orderkey AS doc, l_linenumber AS i, l_partkey % 5 AS article, l_suppkey % 5 AS ref FROM lineitem), h AS (SELECT doc % 50 AS qid, doc, i, row_number() OVER (PARTITION BY doc % 50 ORDER BY doc, i, article, ref) AS rank FROM c), f AS (SELECT DISTINCT qid, h.doc, c.ref FROM h JOIN c ON h.doc = c.doc AND h.i = c.i WHERE rank <= 3), x AS (SELECT DISTINCT qid, f.doc AS doc_id, c.i AS chunk_index FROM f JOIN c ON f.doc = c.doc AND f.ref = c.article) SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.qid = x.qid AND h.doc = x.doc_id AND h.i = x.chunk_index AND h.rank <= 3)")
def expand_references(s, d):
    from pyspark.sql import Window

    c = table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("chunk_index"), (F.col("l_partkey") % 5).alias("article"), (F.col("l_suppkey") % 5).alias("ref"))
    h = c.withColumn("qid", F.col("doc_id") % 50)
    h = h.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("doc_id", "chunk_index", "article", "ref"))).where("rank <= 3")
    return L.expand_references(h, c.select("doc_id", "chunk_index", F.col("ref").alias("article")), c, 3)


@plans.add("rollout_stage", "SELECT user_id AS candidate, CASE WHEN bool_or(event_type = 'error' AND value > 100) THEN 'rolled_back' WHEN count(*) FILTER (event_type = 'click' AND event_id % 50 = 0) = 0 THEN 'shadow' WHEN count(*) FILTER (event_type = 'click' AND event_id % 50 = 0) = 1 THEN 'five_percent' ELSE 'production' END AS stage FROM events GROUP BY user_id")
def rollout_stage(s, d):
    e = table(s, d, "events")
    what = F.when((F.col("event_type") == "error") & (F.col("value") > 100), "breach").when((F.col("event_type") == "click") & (F.col("event_id") % 50 == 0), "promote").otherwise("none")
    return L.rollout(e.select(F.col("user_id").alias("candidate"), F.col("ts").alias("at"), what.alias("event")))


@plans.add("snapshot_publish", "SELECT source, count(*) AS clean FROM documents WHERE length(regexp_replace(text, '\\s', '', 'g')) >= 30 GROUP BY source".replace("\\\\", "\\"))
def snapshot_publish(s, d):
    root = f"{shared_dir(s)}/quarry/generations-{uuid.uuid4().hex}"
    W.snapshot(table(s, d, "documents"), root, "g1")
    return s.read.parquet(f"{root}/g1/documents").groupBy("source").agg(F.count("*").alias("clean"))


@plans.add("flag_update", "SELECT doc_id, lang = 'en' OR coalesce(q, 0) = 1 AS flag FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) USING (doc_id)")
def flag_update(s, d):
    docs = table(s, d, "documents").select("doc_id", (F.col("lang") == "en").alias("flag"))
    return W.update_flags(docs, table(s, d, "labels").select("doc_id", (F.col("quality") == 1).alias("value")), ["doc_id"], "flag")
