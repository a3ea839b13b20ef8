"""Queries over evaluation operators. Relevant to a benchmark item: documents that hold all of its text (grade 2) or its
first 40 characters (grade 1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluation as E
from quarry.operators import retrieval as R
from quarry.operators.evaluation import POISSON
from quarry.operators.selection import first_by_hash
from quarry.plans.base import Plans
from quarry.plans.search import BM25_CTES, _index
from quarry.session import table

plans = Plans()


def _qrels(s, d):
    """Graded by rule from the ids, so that every depth, tie and missing case occurs."""
    q = table(s, d, "benchmark").select(F.col("item_id").alias("qid"))
    docs = table(s, d, "documents").select("doc_id")
    return docs.withColumn("qid", F.col("doc_id") % 40).join(q, "qid").where("(doc_id * 7 + qid) % 5 < 2").select("qid", "doc_id", ((F.col("doc_id") * 7 + F.col("qid")) % 5 + 1).cast("int").alias("grade"))


QRELS = "qrel AS (SELECT item_id AS qid, doc_id, ((doc_id * 7 + item_id) % 5 + 1)::INT AS grade FROM documents JOIN benchmark ON doc_id % 40 = item_id WHERE (doc_id * 7 + item_id) % 5 < 2)"
TOP = "top AS (SELECT qid, doc_id, score, rank FROM bmr WHERE rank <= 50)"
GROUPS = "grp AS (SELECT qid, doc_id % 3 AS group_id, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE doc_id END AS doc_id, grade FROM qrel)"


def _top(s, d):
    q = table(s, d, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return R.bm25(_index(s, d), q, 50), q


def _groups(s, d):
    q = _qrels(s, d)
    return q.select("qid", (F.col("doc_id") % 3).alias("group_id"), F.when(F.col("doc_id") % 3 != 2, F.col("doc_id")).alias("doc_id"), "grade")


RANKING_SQL = f"""WITH {BM25_CTES}, {QRELS}, {TOP},
h AS (SELECT qid, min(rank) AS first, sum(CASE WHEN rank <= 10 THEN (pow(2, grade) - 1) / log2(rank + 1) END) AS dcg FROM top JOIN qrel USING (qid, doc_id) GROUP BY qid),
i AS (SELECT qid, sum((pow(2, grade) - 1) / log2(r + 1)) AS ideal FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY grade DESC, doc_id) AS r FROM qrel) WHERE r <= 10 GROUP BY qid)
SELECT item_id AS qid, coalesce(first <= 1, false)::INT AS success_1, coalesce(first <= 5, false)::INT AS success_5, coalesce(first <= 10, false)::INT AS success_10, round(CASE WHEN first <= 10 THEN 1.0::DOUBLE / first ELSE 0 END, 6) AS mrr, round(least(1.0, coalesce(dcg / ideal, 0)), 6) AS ndcg
FROM benchmark LEFT JOIN h ON h.qid = item_id LEFT JOIN i ON i.qid = item_id"""


@plans.add("success_mrr_ndcg", RANKING_SQL)
def success_mrr_ndcg(s, d):
    top, q = _top(s, d)
    return E.ranking_scores(top, _qrels(s, d), q)


@plans.add("evidence_recall", f"""WITH {BM25_CTES}, {QRELS}, {TOP}, {GROUPS},
z AS (SELECT qid, count(DISTINCT group_id) AS groups FROM grp GROUP BY qid),
f AS (SELECT qid, group_id, min({{'r': rank, 'g': -grade}}) AS m FROM grp JOIN top USING (qid, doc_id) WHERE rank <= 10 GROUP BY 1, 2),
p AS (SELECT qid, count(*) AS met, sum((pow(2, -m.g) - 1) / log2(m.r + 1)) AS dcg FROM f GROUP BY qid),
i AS (SELECT qid, sum((pow(2, grade) - 1) / log2(r + 1)) AS ideal FROM (SELECT qid, grade, row_number() OVER (PARTITION BY qid ORDER BY grade DESC, group_id) AS r FROM (SELECT qid, group_id, max(grade) AS grade FROM grp GROUP BY 1, 2)) WHERE r <= 10 GROUP BY qid)
SELECT item_id AS qid, coalesce(groups, 0) AS groups, round(coalesce(coalesce(met, 0)::DOUBLE / groups, 0), 6) AS group_recall, round(least(1.0, coalesce(dcg / ideal, 0)), 6) AS group_ndcg
FROM benchmark LEFT JOIN z ON z.qid = item_id LEFT JOIN p ON p.qid = item_id LEFT JOIN i ON i.qid = item_id""")
def evidence_recall(s, d):
    top, q = _top(s, d)
    return E.group_scores(top, _groups(s, d), q)


@plans.add("context_quality", f"""WITH {BM25_CTES}, {QRELS}, {TOP}, {GROUPS},
h AS (SELECT qid, rank, doc_id FROM top WHERE rank <= 20),
m AS (SELECT h.*, group_id, min(rank) OVER (PARTITION BY h.qid, group_id) < rank AS old FROM h LEFT JOIN (SELECT DISTINCT qid, doc_id, group_id FROM grp WHERE doc_id IS NOT NULL) g USING (qid, doc_id)),
t AS (SELECT qid, rank, count(group_id) AS n, coalesce(bool_and(CASE WHEN group_id IS NOT NULL THEN old END), false) AS all_old FROM m GROUP BY 1, 2),
o AS (SELECT qid, round(avg((n > 0 AND all_old)::INT), 6) AS duplication, round(avg((n = 0)::INT), 6) AS noise FROM t GROUP BY qid)
SELECT item_id AS qid, coalesce(duplication, 0) AS duplication, coalesce(noise, 1) AS noise FROM benchmark LEFT JOIN o ON o.qid = item_id""")
def context_quality(s, d):
    top, q = _top(s, d)
    return E.context_quality(top, _groups(s, d), q, 20)


@plans.add("reduce_ranking", f"WITH {BM25_CTES}, {TOP}, f AS (SELECT qid, source, min(rank) AS at_ FROM top JOIN documents USING (doc_id) GROUP BY 1, 2) SELECT qid, source, row_number() OVER (PARTITION BY qid ORDER BY at_, source)::INT AS rank FROM f")
def reduce_ranking(s, d):
    top, _ = _top(s, d)
    return E.reduce_ranking(top.join(table(s, d, "documents").select("doc_id", "source"), "doc_id"), "source")


@plans.add("answer_margin", f"WITH {BM25_CTES} SELECT a.qid, a.doc_id AS top_doc, a.score AS top_score, round(a.score - coalesce(b.score, 0), 6) AS margin FROM bmr a LEFT JOIN bmr b ON a.qid = b.qid AND b.rank = 2 WHERE a.rank = 1")
def answer_margin(s, d):
    return E.answer_margin(_top(s, d)[0])


@plans.add("metric_breakdown", f"WITH m AS ({RANKING_SQL}), g AS (SELECT *, CASE WHEN qid % 2 = 0 THEN 'even' ELSE 'odd' END AS kind FROM m) SELECT kind, round(avg(mrr), 6) AS mrr, count(mrr) AS n_mrr, round(avg(ndcg), 6) AS ndcg, count(ndcg) AS n_ndcg FROM g GROUP BY ROLLUP (kind)")
def metric_breakdown(s, d):
    m = success_mrr_ndcg(s, d).withColumn("kind", F.when(F.col("qid") % 2 == 0, "even").otherwise("odd"))
    return E.metric_table(m, ["mrr", "ndcg"], "kind")


@plans.add("latency_percentiles", "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, quantile_disc(value, 0.95) AS p95_disc FROM events GROUP BY event_type")
def latency_percentiles(s, d):
    return E.percentiles(table(s, d, "events"), "value", "event_type")


@plans.add("truncated_percentile", "SELECT source, n_chars AS value FROM (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS r, least(count(*) OVER (PARTITION BY source) - 1, floor(0.95::DOUBLE * count(*) OVER (PARTITION BY source))) AS i FROM documents) WHERE r = i")
def truncated_percentile(s, d):
    return E.rank_percentile(table(s, d, "documents"), "n_chars", "source", 95, "truncate")


@plans.add("rounded_percentile", "SELECT event_type, value FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r, round_even(0.01::DOUBLE * (count(*) OVER (PARTITION BY event_type) - 1), 0) AS i FROM events) WHERE r = i")
def rounded_percentile(s, d):
    return E.rank_percentile(table(s, d, "events"), "value", "event_type", 1, "round")


@plans.add("abstention", "SELECT round(avg(CASE WHEN quality = 1 THEN (n_chars >= 1500)::INT END), 6) AS retention, round(avg(CASE WHEN quality = 0 THEN (n_chars < 1500)::INT END), 6) AS correct_refusal, round(avg(CASE WHEN quality = 1 THEN (n_chars < 1500)::INT END), 6) AS false_refusal, round(avg(CASE WHEN quality = 0 THEN (n_chars >= 1500)::INT END), 6) AS false_accept FROM labels JOIN documents USING (doc_id)")
def abstention(s, d):
    j = table(s, d, "labels").join(table(s, d, "documents"), "doc_id")
    return E.abstention(j.select((F.col("quality") == 1).alias("answerable"), F.col("n_chars").alias("score")), 1500)


@plans.add("panel_majority", "SELECT doc_id % 97 AS item, count(*) AS judges, sum(quality) * 2 > count(*) AS faithful, sum(toxic) * 2 > count(*) AS abstained FROM labels GROUP BY 1")
def panel_majority(s, d):
    v = table(s, d, "labels").select((F.col("doc_id") % 97).alias("item"), (F.col("quality") == 1).alias("faithful"), (F.col("toxic") == 1).alias("abstained"))
    return E.panel_majority(v, "item", ["faithful", "abstained"])


WILSON = "round(least(1.0, greatest(0.0, (k::DOUBLE / n + 2.705543454095404 / (2 * n) + 1.6448536269514722 * sqrt(k::DOUBLE / n * (1 - k::DOUBLE / n) / n + 2.705543454095404 / (4.0 * n * n))) / (1 + 2.705543454095404 / n))), 8)"


@plans.add("wilson_bounds", f"WITH c AS (SELECT source, count(*) AS n, sum(toxic) AS k FROM labels JOIN documents USING (doc_id) GROUP BY source) SELECT source, n AS total, k AS errors, {WILSON} AS upper FROM c")
def wilson_bounds(s, d):
    c = table(s, d, "labels").join(table(s, d, "documents"), "doc_id").groupBy("source").agg(F.count("*").alias("total"), F.sum("toxic").alias("errors"))
    return c.withColumn("upper", E.wilson(F.col("errors"), F.col("total")))


@plans.add("holm_adjust", "WITH t AS (SELECT source AS name, round(avg(n_chars) / 100000, 6) AS p FROM documents GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY p, name) AS i, count(*) OVER () AS m FROM t) SELECT name, p, round(least(1.0, max((m - i + 1) * p) OVER (ORDER BY p, name ROWS UNBOUNDED PRECEDING)), 8) AS adjusted FROM r")
def holm_adjust(s, d):
    return E.holm(table(s, d, "documents").groupBy(F.col("source").alias("name")).agg(F.round(F.avg("n_chars") / 100000, 6).alias("p")))


@plans.add("bootstrap_ci", f"""
WITH c AS (SELECT lang AS metric, source AS cluster, sum(quality)::DOUBLE AS s, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1, 2),
d AS (SELECT *, md5('12345/' || block || '/' || cluster) AS h FROM c, range(0, 2500) AS r(block)),
u AS (SELECT metric, s, n, block * 4 + i AS b, (('0x' || substr(h, (8 * i + 1)::INT, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS u FROM d, range(0, 4) AS q(i)),
k AS (SELECT metric, b, s, n, len(list_filter({POISSON}::DOUBLE[], lambda x: x <= u)) AS k FROM u),
m AS (SELECT metric, b, sum(k * s) / nullif(sum(k * n), 0) AS m FROM k GROUP BY 1, 2),
e AS (SELECT metric, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM m WHERE m IS NOT NULL GROUP BY 1)
SELECT metric, sum(s) / sum(n) AS mean, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS clusters FROM c JOIN e USING (metric) GROUP BY metric""")
def bootstrap_ci(s, d):
    j = table(s, d, "labels").join(table(s, d, "documents"), "doc_id")
    return E.bootstrap_ci(j.select("lang", F.col("source").alias("cluster"), F.col("quality").cast("double").alias("value")).withColumnRenamed("lang", "metric"))


@plans.add("permutation_p", """
WITH c AS (SELECT lang AS metric, source AS cluster, sum(quality - toxic)::DOUBLE AS d, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1, 2),
h AS (SELECT *, md5('12345/' || block || '/' || cluster) AS h FROM c, range(0, 79) AS r(block)),
x AS (SELECT metric, block * 128 + i AS b, sum(CASE WHEN (('0x' || substr(h, (i // 4 + 1)::INT, 1))::INT >> (i % 4)::INT) & 1 = 1 THEN d ELSE -d END) AS x FROM h, range(0, 128) AS q(i) WHERE block * 128 + i < 10000 GROUP BY 1, 2),
t AS (SELECT metric, sum(d) AS s, sum(n) AS n FROM c GROUP BY 1)
SELECT t.metric, any_value(s / n) AS diff, CASE WHEN any_value(abs(s)) <= 1e-12 THEN 1.0 ELSE (count(*) FILTER (abs(x / n) >= abs(s / n) - 1e-12) + 1)::DOUBLE / 10001 END AS p FROM x JOIN t USING (metric) GROUP BY t.metric""")
def permutation_p(s, d):
    j = table(s, d, "labels").join(table(s, d, "documents"), "doc_id")
    return E.permutation_p(j.select(F.col("lang").alias("metric"), F.col("source").alias("cluster"), F.col("quality").cast("double").alias("a"), F.col("toxic").cast("double").alias("b")))


@plans.add("risk_band", f"WITH b(lo, hi, band, k, n) AS (VALUES (0, 500, 'short', 3, 50), (500, 2000, 'middle', 1, 80), (2000, 100000000, 'long', 0, 0)) SELECT doc_id, n_chars AS score, band, CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE {WILSON} END AS error_limit FROM documents LEFT JOIN b ON n_chars >= lo AND n_chars < hi".replace("/ n", "/ nullif(n, 0)"))
def risk_band(s, d):
    bands = s.createDataFrame([(0, 500, "short", 3, 50), (500, 2000, "middle", 1, 80), (2000, 10**8, "long", 0, 0)], "lo long, hi long, band string, errors long, total long")
    return E.risk_band(table(s, d, "documents").select("doc_id", F.col("n_chars").alias("score")), bands)


@plans.add("span_overlap_join", "WITH c AS (SELECT doc_id, i::INT AS chunk_index, i * 500 AS cs, least(n_chars, i * 500 + 600) AS ce FROM (SELECT doc_id, n_chars, unnest(range(0, n_chars // 500 + 1)) AS i FROM documents)), s AS (SELECT doc_id, j::INT AS span_id, j * 333 AS s, j * 333 + 120 * (j % 2) AS e FROM (SELECT doc_id, unnest(range(0, 4)) AS j FROM documents)) SELECT s.doc_id, span_id, chunk_index, s, e FROM s JOIN c ON s.doc_id = c.doc_id AND ((s < ce AND cs < e) OR (s = e AND cs <= s AND s <= ce))")
def span_overlap_join(s, d):
    docs = table(s, d, "documents").select("doc_id", "n_chars")
    c = docs.select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.floor(F.col("n_chars") / 500).cast("int"))).alias("chunk_index"))
    c = c.select("doc_id", "chunk_index", (F.col("chunk_index") * 500).cast("long").alias("cs"), F.least("n_chars", F.col("chunk_index") * 500 + 600).alias("ce"))
    p = docs.select("doc_id", F.explode(F.array(*map(F.lit, range(4)))).alias("span_id"))
    p = p.select("doc_id", "span_id", (F.col("span_id") * 333).cast("long").alias("s"), (F.col("span_id") * 333 + 120 * (F.col("span_id") % 2)).cast("long").alias("e"))
    return E.overlap_join(p, c).select("doc_id", "span_id", "chunk_index", "s", "e")


@plans.add("stratified_sample", "WITH c AS (SELECT lang, count(*) AS n, greatest(1, round_even(100 * count(*)::DOUBLE / (SELECT count(*) FROM documents), 0)) AS quota FROM documents GROUP BY lang), r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed' || doc_id::VARCHAR), doc_id) AS i FROM documents) SELECT doc_id, lang FROM r JOIN c USING (lang) WHERE i <= quota")
def stratified_sample(s, d):
    docs = table(s, d, "documents").select("doc_id", "lang")
    total = docs.agg(F.count("*").alias("t"))
    quota = docs.groupBy("lang").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("lang", F.greatest(F.lit(1.0), F.bround(100 * F.col("n") / F.col("t"))).alias("quota"))
    return first_by_hash(docs, "lang", quota).select("doc_id", "lang")
