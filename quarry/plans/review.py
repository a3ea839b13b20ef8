"""Queries over identity, validation, release and lint operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import chunking as K
from quarry.operators import review as V
from quarry.operators import structure as U
from quarry.operators.components import connected_components
from quarry.plans.base import Plans
from quarry.plans.curation import VERSIONS, _versions
from quarry.plans.engine import Engine
from quarry.plans.evaluation import WILSON
from quarry.plans.search import BM25_CTES, _index, _queries
from quarry.session import table

plans = Plans()


@plans.add("citation_lookup", "WITH r AS (SELECT item_id AS qid, 'src' || item_id AS value, 1 AS priority FROM benchmark UNION ALL SELECT item_id, 'en' || item_id % 3, 2 FROM benchmark), d AS (SELECT doc_id, CASE WHEN doc_id < 10 THEN source ELSE lang || doc_id % 50 END AS code FROM documents), h AS (SELECT DISTINCT qid, doc_id, priority FROM r JOIN d ON value = code), o AS (SELECT h.* FROM h JOIN (SELECT qid, min(priority) AS priority FROM h GROUP BY 1) USING (qid, priority)), n AS (SELECT qid, count(DISTINCT doc_id) AS n FROM o GROUP BY 1) SELECT qid, doc_id, rank, n > 1 AS ambiguous, round(CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / greatest(n, 2) END, 6) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY doc_id)::INT AS rank FROM o) JOIN n USING (qid) WHERE rank <= 3")
def citation_lookup(s, d):
    b = table(s, d, "benchmark")
    refs = b.select(F.col("item_id").alias("qid"), F.concat(F.lit("src"), "item_id").alias("value"), F.lit(1).alias("priority")).union(b.select("item_id", F.concat(F.lit("en"), (F.col("item_id") % 3).cast("string")), F.lit(2)))
    docs = table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") < 10, F.col("source")).otherwise(F.concat("lang", (F.col("doc_id") % 50).cast("string"))).alias("code"))
    return V.resolve_citations(refs, docs)


@plans.add("temporal_candidates", f"WITH {VERSIONS}, c AS (SELECT document_id AS doc_id, version_id, effective_from, CASE WHEN document_id % 5 = 0 THEN NULL ELSE effective_to END AS effective_to, document_id % 7 <> 0 AS normative FROM v), l AS (SELECT * FROM c WHERE NOT normative OR (effective_from <= TIMESTAMP '1996-06-01' AND (effective_to IS NULL OR effective_to > TIMESTAMP '1996-06-01'))) SELECT doc_id, version_id, NOT normative OR min(CASE WHEN normative THEN version_id END) OVER (PARTITION BY doc_id) = max(CASE WHEN normative THEN version_id END) OVER (PARTITION BY doc_id) AS unambiguous FROM l")
def temporal_candidates(s, d):
    v = _versions(s, d).withColumnRenamed("document_id", "doc_id")
    v = v.withColumn("effective_to", F.when(F.col("doc_id") % 5 != 0, F.col("effective_to"))).withColumn("normative", F.col("doc_id") % 7 != 0)
    return V.select_temporal(v, F.lit("1996-06-01").cast("timestamp_ntz")).select("doc_id", "version_id", "unambiguous")


CLAIMS = "c AS (SELECT doc_id AS claim_id, CASE WHEN doc_id % 11 = 0 THEN -doc_id ELSE doc_id END AS evidence_id, lang AS lang, CASE WHEN doc_id % 5 = 0 THEN 'x' || substr(text, 4, 10) WHEN doc_id % 13 = 0 THEN '' ELSE substr(text, 4, 10) END AS quote, 3 AS quote_start FROM documents), e AS (SELECT doc_id AS evidence_id, text, DATE '2020-01-01' + (doc_id % 40)::INT AS valid_from FROM documents WHERE doc_id > 0), j AS (SELECT c.*, text, valid_from FROM c LEFT JOIN e USING (evidence_id)), bad AS (SELECT claim_id, 'no_evidence' AS code FROM j WHERE text IS NULL UNION ALL SELECT claim_id, 'empty_quote' FROM j WHERE quote = '' UNION ALL SELECT claim_id, 'quote_differs' FROM j WHERE substr(text, quote_start + 1, length(quote)) <> quote UNION ALL SELECT claim_id, 'not_effective' FROM j WHERE valid_from > DATE '2020-02-05')"


def _claims(s, d):
    t, i = F.col("text"), F.col("doc_id")
    docs = table(s, d, "documents")
    c = docs.select(i.alias("claim_id"), F.when(i % 11 == 0, -i).otherwise(i).alias("evidence_id"), "lang", F.when(i % 5 == 0, F.concat(F.lit("x"), F.substring(t, 4, 10))).when(i % 13 == 0, "").otherwise(F.substring(t, 4, 10)).alias("quote"), F.lit(3).alias("quote_start"))
    e = docs.where("doc_id > 0").select(i.alias("evidence_id"), "text", F.date_add(F.lit("2020-01-01").cast("date"), (i % 40).cast("int")).alias("valid_from"))
    return c, V.validate_claims(c, e, F.lit("2020-02-05").cast("date"))


@plans.add("validate_claims", f"WITH {CLAIMS} SELECT * FROM bad")
def validate_claims(s, d):
    return _claims(s, d)[1]


@plans.add("claim_coverage", f"WITH {CLAIMS} SELECT lang, count(*) AS claims, count(*) FILTER (b.claim_id IS NULL) AS supported, round(avg((b.claim_id IS NULL)::INT), 6) AS coverage FROM c LEFT JOIN (SELECT DISTINCT claim_id FROM bad) b USING (claim_id) GROUP BY lang".replace("b.claim_id IS NULL", "b.hit IS NULL").replace("(SELECT DISTINCT claim_id FROM bad) b", "(SELECT DISTINCT claim_id, 1 AS hit FROM bad) b"))
def claim_coverage(s, d):
    c, bad = _claims(s, d)
    return V.claim_coverage(c, bad, "lang")


GATE = f"WITH o AS (SELECT event_type AS candidate, user_id AS cluster, value > 5 AS answered, event_id % 211 = 0 AS severe, event_id % 97 = 0 AS material, value AS seconds FROM events), q AS (SELECT candidate, count(*) AS n, count(*) FILTER (severe) AS k, count(*) FILTER (material) AS m, quantile_disc(seconds, 0.95) AS p95 FROM o WHERE answered GROUP BY 1), cl AS (SELECT candidate, count(*) AS n, count(*) FILTER (s) AS k, count(*) FILTER (t) AS m FROM (SELECT candidate, cluster, bool_or(severe) AS s, bool_or(material) AS t FROM o WHERE answered GROUP BY 1, 2) GROUP BY 1), a AS (SELECT candidate, round(avg(answered::INT), 6) AS coverage FROM o GROUP BY 1), w AS (SELECT candidate, {WILSON} AS qs FROM q), w2 AS (SELECT candidate, {WILSON} AS cs FROM cl), w3 AS (SELECT candidate, {WILSON} AS qm FROM (SELECT candidate, n, m AS k FROM q)), w4 AS (SELECT candidate, {WILSON} AS cm FROM (SELECT candidate, n, m AS k FROM cl)), r AS (SELECT candidate, q.n AS answers, coverage, p95, greatest(qs, cs) AS severe_limit, greatest(qm, cm) AS material_limit FROM a JOIN q USING (candidate) JOIN w USING (candidate) JOIN w2 USING (candidate) JOIN w3 USING (candidate) JOIN w4 USING (candidate)) SELECT *, answers >= 1000 AND severe_limit < 0.6 AND material_limit < 0.9 AND coverage >= 0.5 AND p95 <= 1000000 AS passes FROM r"


def _gate(s, d):
    e = table(s, d, "events")
    o = e.select(F.col("event_type").alias("candidate"), F.col("user_id").alias("cluster"), (F.col("value") > 5).alias("answered"), (F.col("event_id") % 211 == 0).alias("severe"), (F.col("event_id") % 97 == 0).alias("material"), F.col("value").alias("seconds"))
    return V.release_gate(o, 1000, 0.6, 0.9, 0.5, 1_000_000)


@plans.add("release_gate", GATE)
def release_gate(s, d):
    return _gate(s, d)


@plans.add("release_winner", f"SELECT candidate FROM ({GATE}) ORDER BY passes DESC, severe_limit, coverage DESC, candidate LIMIT 1")
def release_winner(s, d):
    return V.winner(_gate(s, d), [F.desc("passes"), F.col("severe_limit"), F.desc("coverage"), F.col("candidate")]).select("candidate")


@plans.add("hard_negatives", "WITH p AS (SELECT doc_id % 40 AS qid, doc_id, lang AS kind, doc_id % 17 AS priority, sha256(text) AS hash FROM documents), o AS (SELECT *, row_number() OVER (PARTITION BY qid, hash ORDER BY priority, doc_id) AS dd FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY qid, kind ORDER BY priority, doc_id) AS n FROM o WHERE dd = 1) SELECT qid, doc_id, kind, pick FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n > 1, priority, doc_id)::INT AS pick FROM k) WHERE pick <= 6")
def hard_negatives(s, d):
    p = table(s, d, "documents").select((F.col("doc_id") % 40).alias("qid"), "doc_id", F.col("lang").alias("kind"), (F.col("doc_id") % 17).alias("priority"), F.sha2("text", 256).alias("hash"))
    return V.hard_negatives(p, 6)


@plans.add("spread_sample", "WITH c AS (SELECT source, count(*) AS c FROM documents GROUP BY 1), t AS (SELECT sum(c) AS t, count(*) AS g FROM c), s AS (SELECT source, t, g, greatest(0, least(75, t) - g) * (c - 1)::DOUBLE / greatest(t - g, 1) AS exact FROM c, t), b AS (SELECT *, floor(exact) AS base FROM s), q AS (SELECT source, 1 + base + (row_number() OVER (ORDER BY exact - base DESC, source) <= greatest(0, least(75, t) - g) - sum(base) OVER ())::INT AS quota FROM b) SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('seed' || doc_id), doc_id) AS r FROM documents) JOIN q USING (source) WHERE r <= quota")
def spread_sample(s, d):
    return V.spread_sample(table(s, d, "documents").select("doc_id", "source"), "source", 75).select("doc_id", "source")


@plans.add("similar_questions", r"WITH t AS (SELECT item_id, list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS s FROM benchmark) SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.s, b.s))::DOUBLE / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS likeness FROM t a JOIN t b ON a.item_id < b.item_id WHERE len(list_intersect(a.s, b.s))::DOUBLE / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) > 0.12")
def similar_questions(s, d):
    return V.similar_questions(_queries(s, d), 0.12)


@plans.add("missing_kinds", "SELECT user_id * 40 + event_id % 40 AS visit, array_to_string(list_sort(list_filter(['click', 'error', 'view'], lambda x: NOT list_contains(list(event_type), x))), ',') AS missing FROM events GROUP BY visit HAVING missing <> ''")
def missing_kinds(s, d):
    e = table(s, d, "events").withColumn("visit", F.col("user_id") * 40 + F.col("event_id") % 40)
    return V.missing_kinds(e, "visit", "event_type", ["view", "click", "error"])


@plans.add("reference_closure", """
WITH r AS (SELECT doc_id, doc_id * 3 % 1500 AS ref FROM documents UNION ALL SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 7 + 1200 END FROM documents)
SELECT ref, count(DISTINCT doc_id) AS citing FROM r WHERE ref IS NOT NULL AND ref NOT IN (SELECT doc_id FROM documents) GROUP BY ref""")
def reference_closure(s, d):
    docs, i = table(s, d, "documents"), F.col("doc_id")
    return V.dangling_references(docs.select("doc_id", (i * 3 % 1500).alias("ref")).union(docs.select("doc_id", F.when(i % 4 != 0, i % 7 + 1200))), docs)


@plans.add("flag_reconcile", """
WITH l AS (SELECT user_id, bool_or(event_type = 'click' AND value > 40) AS ever FROM events GROUP BY 1)
SELECT doc_id AS user_id, CASE WHEN ever IS NULL THEN 'unlisted' WHEN ever THEN 'true' ELSE 'false' END AS flag FROM documents LEFT JOIN l ON user_id = doc_id""")
def flag_reconcile(s, d):
    items = table(s, d, "documents").select(F.col("doc_id").alias("user_id"))
    return V.reconcile_flags(items, table(s, d, "events"), "user_id", (F.col("event_type") == "click") & (F.col("value") > 40))


@plans.add("families", """
WITH RECURSIVE e AS (SELECT doc_id AS a, doc_id + CASE WHEN doc_id % 10 = 9 THEN 31 ELSE 1 END AS b FROM documents),
t AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS o FROM t UNION SELECT r.node, t.b FROM r JOIN t ON r.o = t.a)
SELECT node, min(o) AS component FROM r GROUP BY node""")
def families(s, d):
    i = F.col("doc_id")
    return connected_components(table(s, d, "documents").select(i.alias("a"), (i + F.when(i % 10 == 9, 31).otherwise(1)).alias("b")))


@plans.add("embed_header", "SELECT doc_id, sha256(source || ' > ' || CASE WHEN lang = 'de' THEN '' ELSE lang || ' > ' END || 'body' || chr(10) || chr(10) || text) AS h FROM documents")
def embed_header(s, d):
    t = table(s, d, "documents").select("doc_id", "text", F.col("source").alias("title"), F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("kind"), F.array(F.lit("body")).alias("heading_path"))
    return t.select("doc_id", F.sha2(K.embed_text(), 256).alias("h"))


# Bodies with as many marker lines of each kind as the id says.
MARKED = {"heading": ("i % 3", "'## Part ' || j"), "chapter": ("i % 2", "'თავი IV'"), "article": ("i % 4", "'**მუხლი ' || CASE j WHEN 0 THEN '12¹' WHEN 1 THEN 'XIV' ELSE '3.2' END || ' words'"), "clause": ("i % 5", "j || '.1) one'"), "subclause": ("i % 6", "'ა) letter'")}


@plans.add("structure_flags", """
SELECT doc_id, (doc_id % 3)::INT AS headings, (doc_id % 2)::INT AS chapters, (doc_id % 4)::INT AS articles, (doc_id % 5)::INT AS clauses, (doc_id % 6)::INT AS subclauses,
  CASE WHEN doc_id % 4 > 0 THEN 'article' WHEN doc_id % 3 > 0 THEN 'heading' WHEN doc_id % 5 > 0 THEN 'clause' ELSE 'flat' END AS "primary" FROM documents""")
def structure_flags(s, d):
    return U.structure_summary(_marked(s, d))


def _marked(s, d):
    lines = [F.expr(f"transform(filter(sequence(0, 6), j -> j < {n}), j -> {line})") for n, line in MARKED.values()]
    docs = table(s, d, "documents").withColumn("i", F.col("doc_id"))
    return docs.select("doc_id", F.array_join(F.concat(*lines, F.array(F.lit("plain words, მუხლი 9 among them"))), "\n").alias("text"))


@plans.add("structure_markers", """
WITH k AS (SELECT * FROM (VALUES ('heading', 3), ('chapter', 2), ('article', 4), ('clause', 5), ('subclause', 6)) AS v(kind, m))
SELECT doc_id, kind, CASE kind WHEN 'heading' THEN 'Part ' || j WHEN 'chapter' THEN 'IV' WHEN 'article' THEN CASE j WHEN 0 THEN '12¹' WHEN 1 THEN 'XIV' ELSE '3.2' END WHEN 'clause' THEN j || '.1' ELSE 'ა' END AS id
FROM documents, k, unnest(range(0, 7)) AS x(j) WHERE j < doc_id % m""")
def structure_markers(s, d):
    return U.markers(_marked(s, d)).select("doc_id", "kind", "id")


@plans.add("span_context", """
SELECT doc_id, span_id, CASE WHEN doc_id % 2 > 0 THEN 'IV' END AS chapter, CASE doc_id % 4 WHEN 1 THEN '12¹' WHEN 2 THEN 'XIV' WHEN 3 THEN '3.2' END AS article, CASE WHEN doc_id % 5 > 0 THEN (doc_id % 5 - 1) || '.1' END AS clause,
  CASE WHEN doc_id % 6 > 0 THEN 'ა' END AS subclause, coalesce('article:' || CASE doc_id % 4 WHEN 1 THEN '12¹' WHEN 2 THEN 'XIV' WHEN 3 THEN '3.2' END, CASE WHEN doc_id % 2 > 0 THEN 'chapter:IV' END) AS parent FROM documents, (SELECT 0 AS span_id)""")
def span_context(s, d):
    """The span of each body's last line, which all markers precede."""
    docs = _marked(s, d)
    n = F.length("text").cast("int")
    spans = docs.select("doc_id", F.lit(0).alias("span_id"), (n - 5).alias("start"), n.alias("end"))
    return U.context(spans, U.markers(docs)).drop("start", "end")


@plans.add("refresh_deadlines", "SELECT o_orderkey, o_orderdate + to_days(CASE o_orderstatus WHEN 'F' THEN 30 WHEN 'P' THEN 7 ELSE 1 END) AS due FROM orders")
def refresh_deadlines(s, d):
    o = table(s, d, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "pending").otherwise("incomplete")
    return o.select("o_orderkey", V.refresh_deadline(outcome, F.col("o_orderdate")).alias("due"))


@plans.add("engine_search", f"WITH {BM25_CTES}, f AS (SELECT qid, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT qid, doc_id, rank FROM bmr WHERE rank <= 50 UNION ALL SELECT qid, doc_id, rank FROM spr WHERE rank <= 50) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM f), c AS (SELECT r.*, row_number() OVER (PARTITION BY qid, lang ORDER BY rank) AS n FROM r JOIN documents USING (doc_id) WHERE rank <= 50) SELECT qid, doc_id, score, rank FROM (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY rank)::INT AS rank FROM c WHERE n <= 4) WHERE rank <= 10")
def engine_search(s, d):
    return Engine(table(s, d, "documents"), _index(s, d)).search(_queries(s, d), 10, max_per=("lang", 4))


@plans.add("result_hash")
def result_hash(s, d):
    return V.result_hash(engine_search(s, d))
