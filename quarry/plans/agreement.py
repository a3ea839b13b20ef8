"""Queries over agreement and leakage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import agreement as A
from quarry.operators.components import connected_components
from quarry.plans.base import Plans
from quarry.session import shared_dir, table

plans = Plans()


@plans.add("panel_rates", """
SELECT event_type, count(*) AS items, count(*) FILTER (event_id % 4 <> 0) AS answered, round((count(*) FILTER (event_id % 4 <> 0 AND value > 50))::DOUBLE / nullif(count(*) FILTER (event_id % 4 <> 0), 0), 6) AS faithful,
  round((count(*) FILTER (event_id % 4 <> 0 AND user_id % 2 = 0))::DOUBLE / nullif(count(*) FILTER (event_id % 4 <> 0), 0), 6) AS complete FROM events GROUP BY 1""")
def panel_rates(s, d):
    p = table(s, d, "events").select("event_type", (F.col("event_id") % 4 == 0).alias("abstained"), (F.col("value") > 50).alias("faithful"), (F.col("user_id") % 2 == 0).alias("complete"))
    return A.panel_rates(p, "event_type", ["faithful", "complete"])


@plans.add("paired_runs", "SELECT lang AS metric, doc_id AS query, doc_id % 9 AS cluster, n_chars::DOUBLE AS a, n_chars + 1.5::DOUBLE AS b FROM documents")
def paired_runs(s, d):
    a = table(s, d, "documents").select(F.col("lang").alias("metric"), F.col("doc_id").alias("query"), (F.col("doc_id") % 9).alias("cluster"), F.col("n_chars").cast("double").alias("value"))
    return A.paired(a, a.withColumn("value", F.col("value") + 1.5))


@plans.add("comparison_verdicts", """
SELECT o_orderkey AS name, CASE WHEN p < 0.05 AND lo > 0 THEN 'better' WHEN p < 0.05 AND hi < 0 THEN 'worse' ELSE 'tie' END AS verdict
FROM (SELECT o_orderkey, (o_orderkey % 11 - 5) / 10.0 AS delta, (o_orderkey % 11 - 7) / 10.0 AS lo, (o_orderkey % 11 - 3) / 10.0 AS hi, (o_custkey % 10) / 50.0 AS p FROM orders)""")
def comparison_verdicts(s, d):
    k = F.col("o_orderkey") % 11
    t = table(s, d, "orders").select(F.col("o_orderkey").alias("name"), ((k - 5) / 10).alias("delta"), ((k - 7) / 10).alias("lo"), ((k - 3) / 10).alias("hi"), ((F.col("o_custkey") % 10) / 50).alias("adjusted"))
    return A.verdicts(t).select("name", "verdict")


@plans.add("near_pool", r"""
WITH t AS (SELECT conv_id * 100 + turn AS id, role, list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS s FROM conversations)
SELECT a.id AS qid, b.id AS pool_id, round(len(list_intersect(a.s, b.s))::DOUBLE / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS likeness FROM t a JOIN t b ON a.role = 'user' AND b.role <> 'user'
WHERE len(list_intersect(a.s, b.s))::DOUBLE / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) > 0.12""")
def near_pool(s, d):
    c = table(s, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"), "role", "text")
    return A.near_pool(c.where("role = 'user'"), c.where("role <> 'user'"), 0.12)


@plans.add("paraphrase_lint", r"""
WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS e FROM documents), q AS (SELECT doc_id, e, CASE WHEN doc_id % 5 = 0 THEN [] WHEN doc_id % 2 = 0 THEN e[1:3] ELSE list_append(e[1:1], 'zz§') END AS w FROM t),
u AS (SELECT doc_id, e, list_distinct(list_transform(w, lambda x: replace(x, '§', ''))) AS w FROM q)
SELECT doc_id AS qid, CASE WHEN len(w) > 0 THEN round(len(list_intersect(w, e))::DOUBLE / len(w), 6) END AS likeness, len(w) > 0 AND len(list_intersect(w, e))::DOUBLE / len(w) > 0.5 AS copied FROM u""")
def paraphrase_lint(s, d):
    from quarry.functions.text import tokens

    i, e = F.col("doc_id"), F.array_distinct(tokens(F.col("text")))
    words = F.when(i % 5 == 0, F.array().cast("array<string>")).when(i % 2 == 0, F.slice(e, 1, 3)).otherwise(F.concat(F.slice(e, 1, 1), F.array(F.lit("zz§"))))
    return A.paraphrase_lint(table(s, d, "documents").select(i.alias("qid"), F.array_join(words, " ").alias("text"), F.col("text").alias("evidence")))


@plans.add("leak_free", """
WITH c AS (SELECT event_id % 50 AS qid, event_id AS doc_id, event_id % 13 AS hash, user_id % 17 AS family FROM events), g AS (SELECT unnest(range(0, 50)) AS qid)
SELECT qid, doc_id FROM c WHERE hash <> qid % 13 AND family <> qid % 17 AND doc_id % 19 <> 0""")
def leak_free(s, d):
    e = table(s, d, "events").select((F.col("event_id") % 50).alias("qid"), F.col("event_id").alias("doc_id"), (F.col("event_id") % 13).alias("hash"), (F.col("user_id") % 17).alias("family"))
    gold = s.range(50).select(F.col("id").alias("qid"), (F.col("id") % 13).alias("hash"), (F.col("id") % 17).alias("family"))
    return A.without_leaks(e, gold, e.where("doc_id % 19 = 0")).select("qid", "doc_id")


@plans.add("document_conflicts", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_returnflag AS flag, CASE WHEN l_partkey % 3 <> 0 THEN l_linestatus END AS status FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS chunks, min({'n': l_linenumber, 'f': flag, 's': coalesce(status, '')}) AS m, count(DISTINCT flag) AS f, count(DISTINCT status) + max((status IS NULL)::INT) AS t FROM c GROUP BY 1)
SELECT l_orderkey, chunks, m.f AS flag, nullif(m.s, '') AS status, array_to_string(list_filter([CASE WHEN f > 1 THEN 'flag' END, CASE WHEN t > 1 THEN 'status' END], lambda x: x IS NOT NULL), ',') AS conflicts FROM g""")
def document_conflicts(s, d):
    c = table(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("chunk_index"), F.col("l_returnflag").alias("flag"), F.when(F.col("l_partkey") % 3 != 0, F.col("l_linestatus")).alias("status"))
    return A.document_conflicts(c, "l_orderkey", ["flag", "status"]).withColumn("conflicts", F.array_join("conflicts", ","))


@plans.add("family_ids", "SELECT doc_id AS node, substr(sha256('s:' || (doc_id // 5 * 5)), 1, 16) AS family FROM documents WHERE doc_id // 5 * 5 IN (SELECT doc_id FROM documents WHERE doc_id % 5 = 0) AND doc_id // 5 * 5 + 1 IN (SELECT doc_id FROM documents)")
def family_ids(s, d):
    i = F.col("doc_id")
    e = table(s, d, "documents").where("doc_id % 5 <> 0").select((F.floor(i / 5) * 5).alias("a"), i.alias("b"))
    return A.family_ids(connected_components(e), F.lit("s")).select("node", "family")


@plans.add("repeated_keys", """
SELECT '{"a":' || o_orderkey || ',"b":{"a":1,"c":[{"b":2}]},"t":"x\\"a\\":1",' || CASE o_orderkey % 3 WHEN 0 THEN '"a"' ELSE '"b"' END || ':3}' AS line, CASE o_orderkey % 3 WHEN 0 THEN 'a' ELSE 'b' END AS repeated FROM orders WHERE o_orderkey % 3 < 2""")
def repeated_keys(s, d):
    k = F.col("o_orderkey")
    last = F.when(k % 3 == 0, '"a"').when(k % 3 == 1, '"b"').otherwise('"d"')
    line = F.concat(F.lit('{"a":'), k.cast("string"), F.lit(',"b":{"a":1,"c":[{"b":2}]},"t":"x\\"a\\":1",'), last, F.lit(":3}"))
    return A.repeated_keys(table(s, d, "orders").select(line.alias("value"))).withColumn("repeated", F.array_join("repeated", ","))


@plans.add("index_reasons", """
SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'empty_body' WHEN doc_id % 6 = 1 THEN 'near_empty' WHEN doc_id % 5 < 2 THEN 'incomplete_content' WHEN doc_id % 7 = 0 THEN 'extraction_scanned_no_text' END AS reason FROM documents""")
def index_reasons(s, d):
    i = F.col("doc_id")
    body = F.when(i % 6 == 0, " ").when(i % 6 == 1, "few").otherwise(F.lit("a body that is long enough to be indexed, with words"))
    return table(s, d, "documents").select("doc_id", A.index_reason(body, F.when(i % 5 == 0, False).when(i % 5 > 1, True), F.when(i % 7 == 0, " Scanned_No_Text").otherwise("full_text")).alias("reason"))


@plans.add("topic_windows", """SELECT o_orderkey AS scope, o_orderdate::DATE AS "from", topic FROM orders LEFT JOIN (SELECT o_orderkey AS k, unnest(['x', 'y']) AS topic FROM orders WHERE o_orderkey % 4 = 0) ON k = o_orderkey""")
def topic_windows(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("scope"), F.col("o_orderdate").cast("date").alias("from"))
    return A.topic_windows(o, o.where("scope % 4 = 0").select("scope", F.explode(F.array(F.lit("x"), F.lit("y"), F.lit("x"))).alias("topic")))


@plans.add("seen_two_phase", """
WITH r AS (SELECT user_id AS key, event_id AS at_, CASE WHEN event_id % 3 = 0 THEN 'success' ELSE 'incomplete' END AS outcome FROM events WHERE event_type IN ('view', 'click'))
SELECT key, arg_max(outcome, at_) AS outcome, max(CASE WHEN outcome = 'success' THEN at_ END) AS last_success, max(at_) AS at FROM r GROUP BY key""")
def seen_two_phase(s, d):
    """Three runs, a type of event each: two are committed, one twice, and one is rolled back."""
    e, i = table(s, d, "events"), F.col("event_id")
    rows = e.select("event_type", F.col("user_id").alias("key"), F.when(i % 3 == 0, "success").otherwise("incomplete").alias("outcome"), i.alias("last_success"), F.sha2("event_type", 256).alias("content_hash"), i.alias("at"))
    store = A.SeenStore(s, f"{shared_dir(s)}/quarry/seen-{uuid.uuid4().hex}")
    for kind in ("view", "click", "error"):
        store.stage(kind, rows.where(F.col("event_type") == kind).drop("event_type"))
    store.commit("view")
    store.rollback("error")
    store.commit("click")
    store.commit("view")
    return store.read().select("key", "outcome", "last_success", "at")
