"""Queries over retrieval operators: benchmark items as queries, documents as passages, embeddings as vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import word_count
from quarry.operators import retrieval as R
from quarry.operators.ivf import InvertedFile
from quarry.plans.base import Plans
from quarry.plans.engine import Engine
from quarry.session import materialize, table

plans = Plans()

TOK = r"regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')"
BM25_CTES = f"""
qt AS (SELECT qid, term, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({TOK}) AS term FROM benchmark) GROUP BY 1, 2),
dt AS (SELECT doc_id, {TOK} AS t FROM documents),
st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM dt),
po AS (SELECT term, doc_id, dl, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM dt) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
idf AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM po, st GROUP BY term, n),
bm AS (SELECT qid, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qt JOIN idf USING (term) JOIN po USING (term), st GROUP BY 1, 2),
bmr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM bm),
sp AS (SELECT qid, doc_id, sum(qtf * tf)::DOUBLE AS score FROM qt JOIN po USING (term) GROUP BY 1, 2),
spr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM sp)
"""


def _docs(s, d):
    return table(s, d, "documents").select("doc_id", "text", "source")


_built: dict = {}


def _index(s, d):
    """The index over the documents of a directory: built by the first query of a session that asks for it."""
    key = s.sparkContext.applicationId, d
    if key not in _built:
        _built[key] = R.LexicalIndex(table(s, d, "documents"), ["lang", "source", "n_chars"], ["lang", "source"])
    return _built[key]


def _queries(s, d):
    return table(s, d, "benchmark").select(F.col("item_id").alias("qid"), "text")


def _ranked_sql(body: str, k: int) -> str:
    return f"WITH {BM25_CTES}, f AS ({body}) SELECT qid, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM f) WHERE rank <= {k}"


@plans.add("lexical_index", f"SELECT term, count(DISTINCT doc_id) AS df, sum(tf)::BIGINT AS tf, max(tf) AS most FROM (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({TOK}) AS term FROM documents) GROUP BY 1, 2) GROUP BY 1")
def lexical_index(s, d):
    """What the kept index says of every term; the first query that asks for it builds it."""
    ix = _index(s, d)
    return ix.terms.join(ix.postings.groupBy("term").agg(F.sum("tf").alias("tf")), "term").select("term", "df", "tf", F.col("top_tf").alias("most"))


@plans.add("bm25_topk", f"WITH {BM25_CTES} SELECT qid, doc_id, score, rank FROM bmr WHERE rank <= 10")
def bm25_topk(s, d):
    return R.bm25(_index(s, d), _queries(s, d), 10)


@plans.add("sparse_topk", f"WITH {BM25_CTES} SELECT qid, doc_id, score, rank FROM spr WHERE rank <= 10")
def sparse_topk(s, d):
    return R.sparse(_index(s, d), _queries(s, d), 10)


FILTERED = {"language": "de", "date_from": "2020-03-01", "date_to": "2020-10-31", "as_of": "2020-06-01", "contains": "die"}


def _dated(s, d):
    """Documents with dates and spans of force from their lengths, for the named filters."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 365).cast("int"))
    return table(s, d, "documents").withColumns({"date": day, "effective_from": F.date_add(day, -30), "effective_to": F.when(F.col("n_chars") % 3 > 0, F.date_add(day, 60))})


@plans.add("filtered_search", f"""WITH {BM25_CTES},
da AS (SELECT doc_id, lang, n_chars, DATE '2020-01-01' + (n_chars % 365)::INT AS date FROM documents),
ok AS (SELECT da.doc_id FROM da JOIN dt USING (doc_id) WHERE lang = 'de' AND date BETWEEN '2020-03-01' AND '2020-10-31' AND date - 30 <= '2020-06-01' AND (n_chars % 3 = 0 OR date + 60 > '2020-06-01') AND list_contains(t, 'die'))
SELECT qid, doc_id, score, rank FROM (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM bm JOIN ok USING (doc_id)) WHERE rank <= 10""")
def filtered_search(s, d):
    """BM25 under five named filters, all of them evaluated by the index: its weights are those of all documents."""
    docs = _dated(s, d)
    index = R.LexicalIndex(docs, ["lang", "date", "effective_from", "effective_to"], ["lang", "date"])
    return Engine(docs, index).search(_queries(s, d), 10, "bm25", pool=10, named=FILTERED, columns={"language": "lang"})


def _vectors(s, d):
    v = table(s, d, "embeddings")
    return v.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), "label"), v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))


DENSE_SQL = "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), f AS (SELECT q.vec_id AS qid, v.vec_id AS doc_id, round(list_cosine_similarity(q.e, v.e), 5) AS score FROM v q, v WHERE q.vec_id % 100 = 0) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank FROM f) WHERE rank <= 10"


@plans.add("dense_topk", DENSE_SQL)
def dense_topk(s, d):
    v, q = _vectors(s, d)
    return R.dense(v, q, 10)


@plans.add("ivf_exhaustive", DENSE_SQL)
def ivf_exhaustive(s, d):
    """The inverted file with all cells probed and no limit on what is rescored: equal to the exact search."""
    v, q = _vectors(s, d)
    index = InvertedFile(v)
    return index.search(q, 10, probes=len(index.centres), depth=0)


@plans.add("ivf_topk")
def ivf_topk(s, d):
    """The inverted file as it is meant to be used; tests/test_vectors.py measures its recall on sf0.1."""
    v, q = _vectors(s, d)
    index = InvertedFile(v)
    return index.search(q, 10, probes=max(8, len(index.centres) * 3 // 4))


@plans.add("rrf_hybrid", _ranked_sql("SELECT qid, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT qid, doc_id, rank FROM bmr WHERE rank <= 50 UNION ALL SELECT qid, doc_id, rank FROM spr WHERE rank <= 50) GROUP BY 1, 2", 10))
def rrf_hybrid(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    return R.rrf(R.bm25(_index(s, d), q, 50), R.sparse(_index(s, d), q, 50), k=10)


def _scaled(t, w):
    return f"SELECT qid, doc_id, {w} * CASE WHEN max(score) OVER p = min(score) OVER p THEN 1.0::DOUBLE ELSE (score - min(score) OVER p) / (max(score) OVER p - min(score) OVER p) END AS s FROM {t} WHERE rank <= 50 WINDOW p AS (PARTITION BY qid)"


@plans.add("weighted_fusion", _ranked_sql(f"SELECT qid, doc_id, round(sum(s), 6) AS score FROM ({_scaled('bmr', '0.7::DOUBLE')} UNION ALL {_scaled('spr', '0.3::DOUBLE')}) GROUP BY 1, 2", 10))
def weighted_fusion(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    return R.weighted(R.bm25(_index(s, d), q, 50), R.sparse(_index(s, d), q, 50), 0.3, 10)


def _dbsf(t):
    return f"SELECT qid, doc_id, CASE WHEN coalesce(stddev_samp(score) OVER p, 0) = 0 THEN 0.5::DOUBLE ELSE least(1.0, greatest(0.0, (score - (avg(score) OVER p - 3 * stddev_samp(score) OVER p)) / (6 * stddev_samp(score) OVER p))) END AS s FROM {t} WHERE rank <= 50 WINDOW p AS (PARTITION BY qid)"


@plans.add("dbsf_fusion", _ranked_sql(f"SELECT qid, doc_id, round(sum(s), 6) AS score FROM ({_dbsf('bmr')} UNION ALL {_dbsf('spr')}) GROUP BY 1, 2", 10))
def dbsf_fusion(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    return R.dbsf(R.bm25(_index(s, d), q, 50), R.sparse(_index(s, d), q, 50), k=10)


SETS = r"SELECT p.qid, p.doc_id, round(len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))), 6) AS score FROM (SELECT * FROM bmr WHERE rank <= 20) p JOIN (SELECT item_id AS qid, list_distinct(" + TOK + r") AS a FROM benchmark) USING (qid) JOIN (SELECT doc_id, list_distinct(t) AS b FROM dt) USING (doc_id)"


@plans.add("rerank_jaccard", _ranked_sql(f"SELECT * FROM ({SETS}) WHERE score >= 0.02", 5))
def rerank_jaccard(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    return R.rerank(R.bm25(_index(s, d), q, 20), q, docs, 5, min_score=0.02)


@plans.add("diversify_cap", f"WITH {BM25_CTES}, c AS (SELECT qid, doc_id, score, rank, source, row_number() OVER (PARTITION BY qid, source ORDER BY rank) AS n FROM bmr JOIN documents USING (doc_id) WHERE rank <= 50) SELECT qid, doc_id, score, source, rank FROM (SELECT qid, doc_id, score, source, row_number() OVER (PARTITION BY qid ORDER BY rank)::INT AS rank FROM c WHERE n <= 1) WHERE rank <= 10")
def diversify_cap(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    pool = materialize(R.bm25(_index(s, d), q, 50), "pool")
    pool = pool.join(R.of_pool(pool, docs).select("doc_id", "source"), "doc_id")
    return R.cap_per_key(pool, "source", 1, 10).select("qid", "doc_id", "score", "source", "rank")


@plans.add("pin_merge", f"WITH {BM25_CTES}, b AS (SELECT item_id AS qid, doc_id, 0 AS p, 1 AS rank FROM benchmark JOIN documents ON doc_id = item_id UNION ALL SELECT qid, doc_id, 1, rank FROM bmr WHERE rank <= 10), m AS (SELECT qid, doc_id, min(p * 1000 + rank) AS place FROM b GROUP BY 1, 2) SELECT * FROM (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY place, doc_id)::INT AS rank FROM m) WHERE rank <= 10")
def pin_merge(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    pinned = q.join(docs.select("doc_id"), F.col("qid") == F.col("doc_id")).select("qid", "doc_id", F.lit(1).alias("rank"))
    return R.pin(pinned, R.bm25(_index(s, d), q, 10), 10)


@plans.add("union_candidates", f"WITH {BM25_CTES}, b AS (SELECT qid, doc_id, 0 AS branch, rank AS branch_rank FROM bmr WHERE rank <= 10 UNION ALL SELECT qid, doc_id, 1, rank FROM spr WHERE rank <= 10), m AS (SELECT *, row_number() OVER (PARTITION BY qid, doc_id ORDER BY branch, branch_rank) AS n FROM b) SELECT qid, doc_id, branch, branch_rank, row_number() OVER (PARTITION BY qid ORDER BY branch, branch_rank, doc_id)::INT AS rank FROM m WHERE n = 1")
def union_candidates(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    return R.union_candidates([R.bm25(_index(s, d), q, 10), R.sparse(_index(s, d), q, 10)])


@plans.add("mmr_diversify")
def mmr_diversify(s, d):
    v, q = _vectors(s, d)
    pool = R.dense(v, q, 30).join(v.select("doc_id", "vector", F.col("label").alias("key")), "doc_id")
    return R.mmr(pool, 10, 0.5)


BUDGET_SQL = f"""WITH RECURSIVE {BM25_CTES},
pool AS (SELECT qid, doc_id, rank, len(regexp_extract_all(text, '\\S+'))::BIGINT AS tokens FROM bmr JOIN documents USING (doc_id) WHERE rank <= 20),
r AS (
  SELECT DISTINCT qid, 0 AS rank, NULL::BIGINT AS doc_id, 0::BIGINT AS tokens, 0::BIGINT AS used, true AS took, 0 AS position FROM pool
  UNION ALL
  SELECT r.qid, p.rank, p.doc_id, p.tokens, r.used + CASE WHEN r.used + p.tokens <= 2000 THEN p.tokens ELSE 0 END, r.used + p.tokens <= 2000, r.position + (r.used + p.tokens <= 2000)::INT
  FROM r JOIN pool p ON p.qid = r.qid AND p.rank = r.rank + 1 WHERE NOT (r.rank = 1 AND NOT r.took))
SELECT qid, doc_id, position, tokens, used FROM r WHERE took AND rank > 0"""


@plans.add("context_token_budget", BUDGET_SQL)
def context_token_budget(s, d):
    docs, q = _docs(s, d), _queries(s, d)
    pool = materialize(R.bm25(_index(s, d), q, 20), "pool")
    pool = pool.join(R.of_pool(pool, docs).select("doc_id", word_count(F.col("text")).cast("long").alias("tokens")), "doc_id")
    return R.token_budget(pool.select("qid", "doc_id", "rank", "tokens"), 2000)
