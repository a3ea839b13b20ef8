"""Queries over gold questions, answers and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import parse as P
from quarry.operators import gold as G
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()

# Three spans a document, chunks of 300 characters every 250; every seventh document has no chunks, every fifth span starts far behind the end.
SPANS = """
spans AS (SELECT doc_id AS qid, n, CASE WHEN doc_id % 11 = 0 THEN doc_id + 100000 ELSE doc_id END AS doc_id, s AS "start", s + 60 AS "end", (doc_id + n) % 3 + 1 AS grade, (doc_id + n) % 4 <> 0 AS required,
  CASE WHEN doc_id % 2 = 0 AND n < 2 THEN 'g' END AS evidence_group, CASE WHEN (doc_id + n) % 6 = 0 THEN 'other' ELSE substr(text, s + 1, 60) END AS quote
  FROM (SELECT doc_id, text, n, CASE WHEN (doc_id + n) % 5 = 0 THEN 900000 ELSE (doc_id * 37 + n * 211) % 3000 END AS s FROM documents, unnest([0, 1, 2]) AS x(n))),
chunks AS (SELECT doc_id, i AS chunk_index, i * 250 AS "start", least(i * 250 + 300, n_chars) AS "end" FROM (SELECT doc_id, n_chars, unnest(range(0, n_chars // 250 + 1)) AS i FROM documents WHERE doc_id % 7 <> 0)),
qrels AS (SELECT qid, coalesce(evidence_group, 'span:' || n) AS group_id, spans.doc_id AS doc_id, chunk_index, max(grade) AS grade, bool_or(required) AS required
  FROM spans LEFT JOIN chunks c ON c.doc_id = spans.doc_id AND c."start" < spans."end" AND c."end" > spans."start" GROUP BY ALL)
"""


def _spans(s, d):
    docs = table(s, d, "documents").select(F.col("doc_id").alias("qid"), "text", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n"))
    q, n = F.col("qid"), F.col("n")
    start = F.when((q + n) % 5 == 0, 900000).otherwise((q * 37 + n * 211) % 3000).cast("int")
    docs = docs.withColumn("start", start)
    quote = F.when((q + n) % 6 == 0, "other").otherwise(F.substring(F.col("text"), F.col("start") + 1, F.lit(60)))
    return docs.select("qid", "n", F.when(q % 11 == 0, q + 100000).otherwise(q).alias("doc_id"), "start", (F.col("start") + 60).alias("end"), ((q + n) % 3 + 1).alias("grade"), ((q + n) % 4 != 0).alias("required"), F.when((q % 2 == 0) & (n < 2), "g").alias("evidence_group"), quote.alias("quote"))


def _chunks(s, d):
    c = table(s, d, "documents").where("doc_id % 7 <> 0").select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_chars") / 250))).alias("chunk_index"))
    return c.select("doc_id", "chunk_index", (F.col("chunk_index") * 250).alias("start"), F.least(F.col("chunk_index") * 250 + 300, "n_chars").alias("end"))


@plans.add("span_qrels", f"WITH {SPANS} SELECT * FROM qrels")
def span_qrels(s, d):
    return G.span_qrels(_spans(s, d), _chunks(s, d))


@plans.add("relevance_failures", f"""WITH {SPANS}, g AS (SELECT qid, group_id, count(chunk_index) AS n FROM qrels WHERE required GROUP BY ALL)
SELECT qid, CASE WHEN e IS NULL THEN 'no required group' ELSE 'required group without chunk' END AS reason
FROM (SELECT DISTINCT qid FROM qrels) LEFT JOIN (SELECT qid, count(*) FILTER (n = 0) AS e FROM g GROUP BY qid) USING (qid) WHERE e IS NULL OR e > 0""")
def relevance_failures(s, d):
    return G.relevance_failures(G.span_qrels(_spans(s, d), _chunks(s, d)))


@plans.add("chunkable_gold", f"WITH {SPANS} SELECT qid, n, spans.doc_id, doc_id IN (SELECT doc_id FROM chunks) AS chunkable FROM spans")
def chunkable_gold(s, d):
    return G.chunkable(_spans(s, d).select("qid", "n", "doc_id"), _chunks(s, d))


@plans.add("span_lint", f"""WITH {SPANS}, j AS (SELECT spans.*, d.doc_id IS NULL AS gone, substr(d.text, "start" + 1, 60) AS cut, EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = spans.doc_id AND c."start" < spans."end" AND c."end" > spans."start") AS met
  FROM spans LEFT JOIN documents d ON d.doc_id = spans.doc_id)
SELECT qid, n, 'document_missing' AS code FROM j WHERE gone UNION ALL SELECT qid, n, 'quote_differs' FROM j WHERE NOT gone AND cut <> quote UNION ALL SELECT qid, n, 'uncovered' FROM j WHERE NOT gone AND NOT met""")
def span_lint(s, d):
    return G.span_lint(_spans(s, d), table(s, d, "documents"), _chunks(s, d))


@plans.add("citation_lint", """
WITH q AS (SELECT doc_id AS qid, CASE WHEN doc_id % 9 = 0 THEN -doc_id - 1 ELSE doc_id END AS doc_id, CASE doc_id % 4 WHEN 0 THEN [] WHEN 1 THEN [source, 'N-' || doc_id] WHEN 2 THEN [substr(text, 3, 5)] ELSE ['absent§'] END AS tokens FROM documents),
j AS (SELECT q.*, d.doc_id IS NULL AS gone, replace('N–' || d.doc_id || ' ' || d.source || '  ' || substr(d.text, 1, 800), '–', '-') AS hay FROM q LEFT JOIN documents d ON d.doc_id = q.doc_id)
SELECT qid, 'no_citation' AS code FROM j WHERE len(tokens) = 0 UNION ALL SELECT qid, 'document_missing' FROM j WHERE gone
UNION ALL SELECT qid, 'token_not_found' FROM j WHERE NOT gone AND len(list_filter(tokens, lambda t: strpos(hay, t) = 0)) > 0
UNION ALL SELECT qid, 'not_in_holdout' FROM j WHERE doc_id % 3 = 0 OR doc_id < 0 UNION ALL SELECT NULL, 'holdout_not_a_superset'""")
def citation_lint(s, d):
    docs, i = table(s, d, "documents"), F.col("doc_id")
    text = F.array().cast("array<string>")
    tokens = F.when(i % 4 == 0, text).when(i % 4 == 1, F.array("source", F.concat(F.lit("N-"), i.cast("string")))).when(i % 4 == 2, F.array(F.substring("text", 3, 5))).otherwise(F.array(F.lit("absent§")))
    q = docs.select(i.alias("qid"), F.when(i % 9 == 0, -i - 1).otherwise(i).alias("doc_id"), tokens.alias("tokens"))
    known = docs.select("doc_id", F.concat(F.lit("N–"), i.cast("string")).alias("number"), F.col("source").alias("code"), F.lit(None).cast("string").alias("title"), "text")
    return G.citation_lint(q, known, docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 2 = 0"))


@plans.add("adapt_questions", """
SELECT doc_id AS qid, CASE doc_id % 3 WHEN 0 THEN 'natural' WHEN 1 THEN 'v3' ELSE 'current' END AS query_type, n, doc_id + n AS doc_id, n * 10 AS "start", n * 10 + 5 AS "end", 2 - n AS grade, g = 0 AS required, 'g' || g AS evidence_group
FROM documents, unnest([0, 1]) AS x(g), unnest([0, 1, 2]) AS y(n) WHERE n <= doc_id % 2 + g""")
def adapt_questions(s, d):
    i = F.col("doc_id")
    tags = F.when(i % 3 == 0, F.array(F.lit("risk_low"), F.lit("natural"), F.lit("current"))).when(i % 3 == 1, F.array(F.lit("risk_high"))).otherwise(F.array(F.lit("current"), F.lit("risk_low")))
    evidence = lambda g: F.transform(F.sequence(F.lit(0), (i % 2 + g).cast("int")), lambda n: F.struct((i + n).alias("doc_id"), (n * 10).alias("start"), (n * 10 + 5).alias("end"), (2 - n).alias("grade")))
    groups = F.array(*[F.struct(F.lit(f"g{g}").alias("name"), F.lit(g == 0).alias("required"), evidence(g).alias("evidence")) for g in (0, 1)])
    return G.adapt_questions(table(s, d, "documents").select(i.alias("qid"), tags.alias("tags"), groups.alias("groups")))


@plans.add("question_rules", """
WITH q AS (SELECT o_orderkey AS qid, o_orderkey % 3 AS risk, o_orderkey % 5 = 0 AS lookup, o_orderkey % 7 = 0 AS cases, o_orderkey % 4 AS tense, o_orderkey % 6 = 0 AS dated, o_orderkey % 8 = 0 AS ids, o_orderkey % 9 = 0 AS heavy,
  o_custkey % 2 = 0 AS multi, o_custkey % 3 AS groups, o_custkey % 5 = 0 AS conflict, o_custkey % 4 AS docs, o_custkey % 10 AS lineage, o_custkey % 3 + 1 AS reviewers, o_custkey % 6 < 3 AS agree, o_custkey % 12 < 6 AS adjudicated FROM orders)
SELECT qid, 'risk_tag_count' AS code FROM q WHERE risk <> 1 UNION ALL SELECT qid, 'lookup_xor_cases' FROM q WHERE lookup AND cases
UNION ALL SELECT qid, 'current_xor_historical' FROM q WHERE tense IN (0, 3) UNION ALL SELECT qid, 'as_of_iff_historical' FROM q WHERE dated <> (tense IN (2, 3))
UNION ALL SELECT qid, 'identifiers_iff_heavy' FROM q WHERE ids <> heavy UNION ALL SELECT qid, 'multi_evidence_groups' FROM q WHERE multi AND groups < 2
UNION ALL SELECT qid, 'conflicting_documents' FROM q WHERE conflict AND docs < 2 UNION ALL SELECT qid, 'lineage_outside_family' FROM q WHERE lineage > 6
UNION ALL SELECT qid, 'reviewer_count' FROM q WHERE reviewers <> 2 UNION ALL SELECT qid, 'adjudicator_iff_disagreement' FROM q WHERE adjudicated = agree""")
def question_rules(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tag = lambda cond, name: F.when(cond, F.lit(name))
    tags = F.array_compact(F.array(tag(k % 3 >= 1, "risk_low"), tag(k % 3 == 2, "risk_high"), tag(k % 5 == 0, "exact_lookup"), tag(k % 7 == 0, "cases_applying"), tag((k % 4).isin(1, 3), "current"), tag((k % 4).isin(2, 3), "historical"), tag(k % 9 == 0, "identifier_heavy"), tag(c % 2 == 0, "multi_evidence"), tag(c % 5 == 0, "conflicting_authorities")))
    ids = F.when(k % 8 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    families = F.sequence(F.lit(0), F.lit(6)).cast("array<bigint>")
    q = table(s, d, "orders").select(
        k.alias("qid"), tags.alias("tags"), F.when(k % 6 == 0, F.col("o_orderdate")).alias("as_of"), ids.alias("identifiers"), (c % 3).alias("required_groups"), (c % 4).alias("documents"),
        F.array(c % 10).alias("lineages"), families.alias("families"), (c % 3 + 1).alias("reviewers"), (c % 6 < 3).alias("agree"), (c % 12 < 6).alias("adjudicated"),
    )
    return G.question_rules(q)


@plans.add("translation_lint", """
WITH t AS (SELECT item_id AS qid, item_id % 5 AS k, item_id % 3 AS m FROM benchmark)
SELECT CASE WHEN k = 4 THEN -qid - 1 ELSE qid END AS qid, code FROM (
SELECT qid, k, 'unknown_question' AS code FROM t WHERE k = 4 UNION ALL SELECT qid, k, 'query_drifted' FROM t WHERE k = 1 OR k = 2 UNION ALL SELECT qid, k, 'source_not_english' FROM t WHERE k = 2 UNION ALL SELECT qid, k, 'target_not_georgian' FROM t WHERE m = 0)""")
def translation_lint(s, d):
    b, i = table(s, d, "benchmark"), F.col("item_id")
    query = F.when(i % 5 == 1, F.concat("text", F.lit(" "))).when(i % 5 == 2, "რა არის").otherwise(F.col("text"))
    t = b.select(F.when(i % 5 == 4, -i - 1).otherwise(i).alias("qid"), query.alias("query"), F.when(i % 3 == 0, "law").otherwise("კანონი").alias("target"))
    return G.translation_lint(t, b.select(i.alias("qid"), "text"), P.language_of(F.col("query")), P.language_of(F.col("target")))


@plans.add("answer_signals", """
WITH h AS (SELECT user_id AS qid, event_id % 12 AS doc_id, event_id % 3 AS chunk_index, value / 400 AS score, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events),
b AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY first_at, doc_id) AS r FROM (SELECT qid, doc_id, max(score) AS score, min(rank) AS first_at FROM h GROUP BY 1, 2)),
q AS (SELECT DISTINCT doc_id AS qid, doc_id % 12 AS gold_doc, doc_id % 3 <> 0 AS known_item FROM documents),
t AS (SELECT qid, max(CASE WHEN r = 1 THEN doc_id END) AS top_doc, max(CASE WHEN r = 1 THEN score END) AS s1, max(CASE WHEN r = 2 THEN score END) AS s2, bool_or(r <= 5 AND doc_id = gold_doc) AS in_k FROM b JOIN q USING (qid) GROUP BY qid),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank, doc_id, chunk_index) AS r FROM (SELECT qid, doc_id, chunk_index, min(rank) AS rank FROM h GROUP BY 1, 2, 3)) WHERE r <= 5),
g AS (SELECT doc_id AS qid, n AS group_id, (doc_id + n) % 12 AS doc_id, CASE WHEN n = 3 THEN NULL ELSE n END AS chunk_index FROM documents, unnest([0, 1, 2, 3]) AS x(n) WHERE n < 3 OR doc_id % 2 = 0),
m AS (SELECT qid, count(DISTINCT group_id) AS met FROM g JOIN f USING (qid, doc_id, chunk_index) GROUP BY qid), z AS (SELECT qid, count(DISTINCT group_id) AS size FROM g GROUP BY qid)
SELECT qid, top_doc, round(coalesce(s1, 0), 6) AS top_score, round(coalesce(s1, 0) - coalesce(s2, 0), 6) AS margin, coalesce(top_doc = gold_doc, false) AS identity_at_1, coalesce(in_k, false) AS identity_at_k,
  round(coalesce(met, 0)::DOUBLE / size, 6) AS span_coverage, coalesce(met, 0) = size AS fully_grounded, known_item AND coalesce(s1, 0) >= 0.92 AND NOT coalesce(top_doc = gold_doc, false) AS confident_wrong
FROM q LEFT JOIN t USING (qid) LEFT JOIN m USING (qid) LEFT JOIN z USING (qid)""")
def answer_signals(s, d):
    from pyspark.sql import Window

    e, i = table(s, d, "events"), F.col("doc_id")
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    hits = e.select(F.col("user_id").alias("qid"), (F.col("event_id") % 12).alias("doc_id"), (F.col("event_id") % 3).alias("chunk_index"), (F.col("value") / 400).alias("score"), rank.alias("rank"))
    docs = table(s, d, "documents")
    q = docs.select(i.alias("qid"), (i % 12).alias("gold_doc"), (i % 3 != 0).alias("known_item")).distinct()
    n = F.col("n")
    g = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")).where("n < 3 or doc_id % 2 = 0")
    g = g.select(i.alias("qid"), n.alias("group_id"), ((i + n) % 12).alias("doc_id"), F.when(n < 3, n).cast("long").alias("chunk_index"))
    return G.answer_signals(hits, q, g, 5)


@plans.add("run_validity", """
WITH s AS (SELECT event_type AS mode, bool_or(event_id % 5000 = 77) AS bad, bool_and(event_id % 7000 <> 5) AS whole, max(event_id) AS m FROM events GROUP BY 1)
SELECT mode, array_to_string(list_filter([CASE WHEN bad THEN 'failed_or_degraded_queries' END, CASE WHEN m % 2 = 0 THEN 'non_deterministic_results' END, CASE WHEN m % 3 < 2 AND m % 4 < 2 THEN 'production_track_not_repeated' END,
  CASE WHEN m % 5 < 3 AND NOT whole THEN 'candidate_metrics_incomplete' END], lambda x: x IS NOT NULL), ',') AS reasons FROM s""")
def run_validity(s, d):
    e, i = table(s, d, "events"), F.col("event_id")
    scores = e.select(F.col("event_type").alias("mode"), (i % 5000 == 77).alias("failed"), F.when(i % 7000 != 5, 0.5).alias("recall50"), F.lit(0.7).alias("recall80"))
    m = F.col("m")
    runs = e.groupBy(F.col("event_type").alias("mode")).agg(F.max("event_id").alias("m")).select("mode", (m % 2 != 0).alias("deterministic"), F.when(m % 4 < 2, 1).otherwise(2).alias("repeats"), (m % 3 < 2).alias("production"), (m % 5 < 3).alias("strict"))
    return G.run_validity(scores, runs).withColumn("reasons", F.array_join("reasons", ","))


@plans.add("outcome_counts", """
WITH c AS (SELECT event_type AS candidate, user_id, count(*) AS n, bool_or(event_id % 211 = 0) AS severe, bool_or(event_id % 97 = 0) AS material FROM events WHERE value > 5 GROUP BY 1, 2)
SELECT candidate, sum(n)::BIGINT AS answers, count(*) AS clusters, count(*) FILTER (severe) AS severe, count(*) FILTER (material) AS material FROM c GROUP BY 1""")
def outcome_counts(s, d):
    i = F.col("event_id")
    o = table(s, d, "events").select(F.col("event_type").alias("candidate"), F.col("user_id").alias("cluster"), (F.col("value") > 5).alias("answered"), (i % 211 == 0).alias("severe"), (i % 97 == 0).alias("material"))
    return G.outcome_counts(o, "candidate", ["severe", "material"])


@plans.add("cited_subset", """
WITH c AS (SELECT DISTINCT event_type AS candidate, event_id % 1700 AS e FROM events), h AS (SELECT doc_id AS e, sha256(source) AS hash FROM documents),
g AS (SELECT candidate, count(*) AS cited, count(*) FILTER (hash IS NULL) AS missing, sum(CASE WHEN hash IS NOT NULL THEN ('0x' || substr(sha256(e || '|' || hash), 1, 12))::BIGINT::HUGEINT END) AS x FROM c LEFT JOIN h USING (e) GROUP BY 1)
SELECT candidate, cited, missing, sha256((cited - missing) || '|' || coalesce(x, 0)) AS digest FROM g""")
def cited_subset(s, d):
    c = table(s, d, "events").select(F.col("event_type").alias("candidate"), (F.col("event_id") % 1700).alias("evidence_id"))
    return G.cited_subset(c, table(s, d, "documents").select(F.col("doc_id").alias("evidence_id"), F.sha2("source", 256).alias("hash")))


@plans.add("outcome_features", """
WITH i AS (SELECT user_id AS qid, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank, value AS score, CASE WHEN event_id % 4 <> 0 THEN (event_id % 10 + 1) / 10.0 END AS confidence, event_id % 3 = 0 AS certain FROM events),
b AS (SELECT DISTINCT user_id AS qid, CASE WHEN event_type = 'view' AND user_id % 3 <> 0 THEN 'translated' WHEN event_type = 'click' THEN 'original' ELSE event_type END AS branch, event_id % 40 AS hit FROM events),
e AS (SELECT qid, hit, count(*) AS n, bool_or(branch = 'original') AS o, bool_or(branch = 'translated') AS t FROM b GROUP BY 1, 2),
a AS (SELECT qid, max(n) AS most, count(*) FILTER (o AND t) AS both_, count(*) FILTER (o OR t) AS any_, bool_or(o) AS o, bool_or(t) AS t FROM e GROUP BY 1), l AS (SELECT qid, count(DISTINCT branch) AS branches FROM b GROUP BY 1)
SELECT qid, coalesce(min(confidence), 1)::DOUBLE AS identity_confidence, round(max(CASE WHEN rank = 1 THEN score END) - max(CASE WHEN rank = 2 THEN score END), 6) AS margin, round(any_value(most)::DOUBLE / any_value(branches), 6) AS route_agreement,
  CASE WHEN any_value(o) AND any_value(t) THEN round(any_value(both_)::DOUBLE / any_value(any_), 6) ELSE 1 END AS translation_agreement, round(avg(certain::INT), 6) AS version_certainty FROM i JOIN a USING (qid) JOIN l USING (qid) GROUP BY qid""")
def outcome_features(s, d):
    from pyspark.sql import Window

    e, i = table(s, d, "events"), F.col("event_id")
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    items = e.select(F.col("user_id").alias("qid"), rank.alias("rank"), F.col("value").alias("score"), F.when(i % 4 != 0, (i % 10 + 1) / 10.0).alias("confidence"), (i % 3 == 0).alias("certain"))
    kind = F.col("event_type")
    branch = F.when((kind == "view") & (F.col("user_id") % 3 != 0), "translated").when(kind == "click", "original").otherwise(kind)
    return G.outcome_features(items, e.select(F.col("user_id").alias("qid"), branch.alias("branch"), (i % 40).alias("hit_id")))
