"""Queries over answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import answers as A
from quarry.operators import retrieval as R
from quarry.plans.base import Plans
from quarry.plans.search import BM25_CTES, _index, _queries
from quarry.session import table

plans = Plans()


@plans.add("static_translations", """
SELECT o_orderkey AS qid, o_orderpriority AS text, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderpriority < '4' THEN 'ka:' || o_orderpriority END AS query FROM orders""")
def static_translations(s, d):
    q = table(s, d, "orders").select(F.col("o_orderkey").alias("qid"), F.col("o_orderpriority").alias("text"))
    m = q.where("text < '4'").select("text", F.concat(F.lit("ka:"), "text").alias("target")).distinct()
    return A.translated(q, m, F.col("qid") % 3 != 0)


@plans.add("idf_cosine_topk", f"""
WITH {BM25_CTES}, ap AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM dt) GROUP BY 1, 2), ix AS (SELECT term, ln(1 + n::DOUBLE / count(*)) AS w FROM ap, st GROUP BY term, n),
dn AS (SELECT doc_id, sqrt(sum(pow(tf * w, 2))) AS d FROM ap JOIN ix USING (term) GROUP BY 1), qn AS (SELECT qid, sqrt(sum(pow(qtf * w, 2))) AS q FROM qt JOIN ix USING (term) GROUP BY 1),
f AS (SELECT qid, doc_id, round(sum(qtf * w * tf * w) / any_value(q) / any_value(d), 6) AS score FROM qt JOIN ix USING (term) JOIN ap USING (term) JOIN dn USING (doc_id) JOIN qn USING (qid) GROUP BY 1, 2)
SELECT qid, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM f) WHERE rank <= 10""")
def idf_cosine_topk(s, d):
    return A.idf_cosine(_index(s, d), _queries(s, d), 10)


@plans.add("stitched_documents", r"SELECT doc_id, sha256(CASE WHEN doc_id % 3 = 0 AND length(text) > 300 THEN substr(text, 1, 300) || chr(10) || chr(10) || substr(text, 301) ELSE text END) AS digest FROM documents WHERE length(text) > 0")
def stitched_documents(s, d):
    """Pieces of 300 characters that repeat the last 60; every third document has a gap after its first piece."""
    i = F.col("doc_id")
    docs = table(s, d, "documents").where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.length("text") - 300) / 240).cast("int")))).alias("piece"))
    start = (F.col("piece") * 240).cast("int")
    gap = (i % 3 == 0) & (F.col("piece") > 0)
    first = F.when(gap & (F.col("piece") == 1), start + 60).otherwise(start)
    end = F.least(start + 300, F.length("text"))
    text = F.substring(F.col("text"), first + 1, end - first)
    p = docs.select("doc_id", "piece", F.when(gap & (F.col("piece") == 1), first + 1).otherwise(first).alias("start"), end.alias("end"), text.alias("text")).where(F.length("text") > 0)
    return A.stitch(p).select("doc_id", F.sha2("text", 256).alias("digest"))


@plans.add("ask", f"""
WITH {BM25_CTES}, q AS (SELECT item_id AS qid, item_id % 4 AS k FROM benchmark), t AS (SELECT bmr.qid, bmr.doc_id, text FROM bmr JOIN documents USING (doc_id) WHERE rank = 1)
SELECT qid, CASE WHEN k = 0 THEN 'clarify' WHEN doc_id IS NULL OR k = 1 THEN 'abstain' ELSE 'answer' END AS status, CASE WHEN k = 0 THEN 'unsupported_language' WHEN doc_id IS NULL THEN 'no_evidence' WHEN k = 1 THEN 'unsupported_claim' END AS reason,
  CASE WHEN k > 1 THEN doc_id END AS doc_id, CASE WHEN k > 1 THEN substr(text, 1, 50) END AS answer FROM q LEFT JOIN t USING (qid)""")
def ask(s, d):
    """Declared languages decide who is to be clarified; a quarter of the composed answers is made up."""
    q = _queries(s, d)
    declared = F.when(F.col("qid") % 4 == 0, "fr").otherwise("en")
    rows = q.withColumn("text", F.when(F.col("qid") % 4 == 1, F.concat(F.lit("¶"), "text")).otherwise(F.col("text")))
    compose = lambda question, evidence: F.when(question.startswith("¶"), "§ made up §").otherwise(F.substring(evidence, 1, 50))
    return A.ask(rows, lambda x: R.bm25(_index(s, d), x, 1), table(s, d, "documents"), compose, declared)
