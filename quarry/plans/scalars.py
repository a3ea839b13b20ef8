"""Queries over scalar functions, chunking, HTML and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import chunking as K
from quarry.functions import html as H
from quarry.functions import parse as P
from quarry.functions import text as T
from quarry.operators import index as I
from quarry.operators import retrieval as R
from quarry.operators import vectors as V
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()

# One of six written forms of each order's date, two of them no dates.
FORM = "CASE o_orderkey % 6 WHEN 0 THEN {iso} WHEN 1 THEN {dmy} WHEN 2 THEN concat({d}, ' მარტის ', {y}) WHEN 3 THEN concat({y}, '-02-30') WHEN 4 THEN 'undated' ELSE concat({iso}, ' 08:00:07') END"
SPARK_FORM = FORM.format(iso="date_format(o_orderdate, 'yyyy-MM-dd')", dmy="date_format(o_orderdate, 'dd/MM/yyyy')", d="date_format(o_orderdate, 'd')", y="date_format(o_orderdate, 'yyyy')")
DUCK_FORM = FORM.format(iso="strftime(o_orderdate, '%Y-%m-%d')", dmy="strftime(o_orderdate, '%d/%m/%Y')", d="day(o_orderdate)::VARCHAR", y="year(o_orderdate)::VARCHAR")


@plans.add("parse_dates", f"SELECT o_orderkey, {DUCK_FORM} AS raw, CASE o_orderkey % 6 WHEN 2 THEN make_date(year(o_orderdate), 3, day(o_orderdate)) WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE o_orderdate::DATE END AS parsed FROM orders")
def parse_dates(s, d):
    o = table(s, d, "orders").selectExpr("o_orderkey", f"{SPARK_FORM} AS raw")
    return o.withColumn("parsed", P.parse_date(F.col("raw")))


@plans.add("date_formats", "SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS dotted, strftime(o_orderdate, '%d/%m/%Y') AS slashed, strftime(o_orderdate, '%Y/%m/%d') AS year_slashed, o_orderdate::DATE AS from_dotnet, o_orderdate::DATE AS from_dotted, strftime(o_orderdate, '%Y-%m-%d') AS prefix, (o_orderdate + INTERVAL 26 HOUR)::DATE AS local FROM orders")
def date_formats(s, d):
    o, c = table(s, d, "orders"), F.col("o_orderdate")
    ms = F.concat(F.lit("/Date("), (F.unix_date(c.cast("date")).cast("bigint") * 86_400_000 + 3_600_000).cast("string"), F.lit(")/"))
    dotted = F.date_format(c, "dd.MM.yyyy")
    return o.select("o_orderkey", dotted.alias("dotted"), F.date_format(c, "dd/MM/yyyy").alias("slashed"), F.date_format(c, "yyyy/MM/dd").alias("year_slashed"), P.dotnet_date(ms).alias("from_dotnet"), P.parse_day_first(dotted).alias("from_dotted"), P.date_prefix(F.date_format(c, "yyyy-MM-dd HH:mm")).alias("prefix"), P.local_date((c.cast("timestamp") + F.expr("interval 22 hours"))).alias("local"))


@plans.add("date_windows", "WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS s, o_orderdate::DATE + 100 AS e FROM orders), w AS (SELECT o_orderkey, s, e, unnest(generate_series(date_trunc('month', s), e::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM o) SELECT o_orderkey, greatest(m, s) AS \"from\", least((m + INTERVAL 1 MONTH)::DATE - 1, e) AS \"to\" FROM w")
def date_windows(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("s"))
    return o.select("o_orderkey", F.inline(P.date_windows(F.col("s"), F.date_add("s", 100))))


@plans.add("status_codes", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'in_force' WHEN 'F' THEN 'repealed' ELSE 'pending' END AS status, CASE WHEN o_orderdate > TIMESTAMP '1996-01-01' THEN 'pending' WHEN o_orderdate + INTERVAL 365 DAY <= TIMESTAMP '1996-01-01' THEN 'repealed' ELSE 'in_force' END AS by_dates, CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS flag, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey::VARCHAR END AS code FROM orders")
def status_codes(s, d):
    o = table(s, d, "orders")
    said = F.when(F.col("o_orderstatus") == "O", "Now in FORCE").when(F.col("o_orderstatus") == "F", "was repealed").otherwise("Pending")
    flag = F.when(F.col("o_orderstatus") == "O", " Yes").when(F.col("o_orderstatus") == "F", "0").otherwise("maybe")
    at = F.lit("1996-01-01").cast("timestamp_ntz")
    code = F.when(F.col("o_orderkey") % 10 == 0, "-000-").otherwise(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", P.status_of(said).alias("status"), P.status_by_dates(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("interval 365 days"), at).alias("by_dates"), P.optional_bool(flag).alias("flag"), P.registration_code(code).alias("code"))


CITE = "CASE doc_id % 7 WHEN 0 THEN concat('see 240140000.05.001.', lpad(cast(doc_id AS {s}), 6, '0')) WHEN 1 THEN concat('no ', lpad(cast(doc_id AS {s}), 18, '3')) WHEN 2 THEN concat('napr ', lpad(cast(doc_id AS {s}), 15, '1'), ' x') WHEN 3 THEN concat('ბრძანება №', cast(doc_id AS {s})) WHEN 4 THEN concat('decision in case AB-', cast(doc_id AS {s}), '/19') WHEN 5 THEN concat('Article ', cast(doc_id AS {s}), ' and article 7, Article 7') ELSE 'what is currently the rule' END"


@plans.add("citations", f"SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'registration_code' WHEN 1 THEN 'document_number' WHEN 2 THEN 'registration_code' WHEN 3 THEN 'document_number' WHEN 4 THEN 'case_number' END AS kind, CASE doc_id % 7 WHEN 0 THEN '240140000.05.001.' || lpad(doc_id::VARCHAR, 6, '0') WHEN 1 THEN lpad(doc_id::VARCHAR, 18, '3') WHEN 2 THEN lpad(doc_id::VARCHAR, 15, '1') WHEN 3 THEN doc_id::VARCHAR WHEN 4 THEN 'AB-' || doc_id || '/19' END AS value, CASE doc_id % 7 WHEN 4 THEN 'case_number' WHEN 5 THEN 'article' WHEN 6 THEN 'current' ELSE 'citation' END AS intent, CASE WHEN doc_id % 7 <> 5 THEN '' WHEN doc_id = 7 THEN '7' ELSE doc_id || ',7' END AS articles, CASE WHEN doc_id % 7 = 3 THEN 'ka' ELSE 'en' END AS language FROM documents")
def citations(s, d):
    q = table(s, d, "documents").selectExpr("doc_id", CITE.format(s="string") + " AS q")
    c = F.col("q")
    return q.select("doc_id", P.citation(c)["kind"].alias("kind"), P.citation(c)["value"].alias("value"), P.intent_of(c).alias("intent"), F.array_join(P.article_references(c), ",").alias("articles"), P.language_of(c).alias("language"))


@plans.add("evidence_ids", """
WITH b AS (SELECT doc_id, source, '{"p0":"' || doc_id || '","p1":"' || source || '"}' AS body FROM documents)
SELECT doc_id, base64(encode(substr(sha256(body), 1, 16) || body)) AS id, CASE WHEN doc_id % 5 <> 0 THEN doc_id::VARCHAR END AS p0, CASE WHEN doc_id % 5 <> 0 THEN source END AS p1 FROM b""")
def evidence_ids(s, d):
    e = table(s, d, "documents").select("doc_id", P.evidence_id(F.col("doc_id"), F.col("source")).alias("id"))
    raw = F.decode(F.unbase64("id"), "UTF-8")
    forged = F.base64(F.encode(F.concat(raw, F.lit(" ")), "UTF-8"))
    return e.select("doc_id", "id", P.read_evidence_id(F.when(F.col("doc_id") % 5 == 0, forged).otherwise(F.col("id")), 2).alias("p")).select("doc_id", "id", "p.*")


@plans.add("token_jaccard", r"WITH t AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS a, list_distinct(regexp_extract_all(replace(lower(lead(text) OVER (PARTITION BY conv_id ORDER BY turn)), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS b FROM conversations) SELECT conv_id, turn, round(CASE WHEN b IS NULL OR len(a) = 0 OR len(b) = 0 THEN 0 ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END, 6) AS likeness FROM t")
def token_jaccard(s, d):
    from pyspark.sql import Window

    c = table(s, d, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    sets = [F.array_distinct(T.tokens(F.col(x))) for x in ("text", "next")]
    return c.select("conv_id", "turn", F.round(T.jaccard(*sets), 6).alias("likeness"))


@plans.add("chunk_documents")
def chunk_documents(s, d):
    return K.chunk_documents(table(s, d, "documents"))


@plans.add("doc_reassemble")
def doc_reassemble(s, d):
    return K.reassemble(K.chunk_documents(table(s, d, "documents"))).select("doc_id", "piece_index", F.length("piece").alias("length"), F.sha2("piece", 256).alias("piece_hash"))


@plans.add("html_to_markdown")
def html_to_markdown(s, d):
    p = table(s, d, "pages")
    return p.select("page_id", H.markdown_of(F.col("html"), F.col("url")).alias("markdown"))


@plans.add("vector_integrity", "SELECT vec_id, 'not_normalised' AS code FROM (SELECT vec_id, CASE WHEN vec_id % 9 = 0 THEN list_transform(embedding, lambda x: x * 2) ELSE embedding END AS e FROM embeddings) WHERE abs(sqrt(list_inner_product(e::DOUBLE[], e::DOUBLE[])) - 1) > 0.001 UNION ALL SELECT vec_id, 'dimension' FROM embeddings WHERE vec_id % 9 = 4")
def vector_integrity(s, d):
    e = F.col("embedding")
    v = table(s, d, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 9 == 0, F.transform(e, lambda x: x * F.lit(2).cast("float"))).when(F.col("vec_id") % 9 == 4, F.concat(e, F.array(F.lit(0).cast("float")))).otherwise(e))
    return V.integrity(v, 64)


@plans.add("nearest_neighbor", "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), f AS (SELECT q.vec_id AS qid, v.vec_id AS doc_id, round(list_cosine_similarity(q.e, v.e), 5) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0) SELECT qid, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS n FROM f) WHERE n = 1")
def nearest_neighbor(s, d):
    v = table(s, d, "embeddings")
    hits = R.dense(v.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")), v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector")), 2)
    return R.ranked(hits.where("qid <> doc_id").drop("rank"), 1, 5).select("qid", "doc_id", "score")


@plans.add("centroids", "SELECT label, i::INT AS i, round(avg(x), 6) AS value FROM (SELECT label, unnest(range(64)) AS i, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY 1, 2")
def centroids(s, d):
    return V.centroids(table(s, d, "embeddings")).withColumn("value", F.round("value", 6))


@plans.add("centroid_likeness", "WITH c AS (SELECT label, i, avg(x) AS v FROM (SELECT label, unnest(range(64)) AS i, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(v * v)) AS n FROM c GROUP BY 1), u AS (SELECT label, i, v / n AS v FROM c JOIN n USING (label)) SELECT a.label AS a, b.label AS b, round(sum(a.v * b.v), 5) AS cosine FROM u a JOIN u b ON a.i = b.i AND a.label < b.label GROUP BY 1, 2")
def centroid_likeness(s, d):
    return V.centroid_likeness(table(s, d, "embeddings"))


@plans.add("crosstab", "SELECT source, lang, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY source), 6) AS share FROM documents GROUP BY source, lang")
def crosstab(s, d):
    return V.crosstab(table(s, d, "documents"), "source", "lang")


@plans.add("value_counts", "SELECT lang, count(*) AS n, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def value_counts(s, d):
    return table(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@plans.add("pca")
def pca(s, d):
    return V.principal_components(table(s, d, "embeddings"))


@plans.add("pca_variance")
def pca_variance(s, d):
    return V.explained_variance(table(s, d, "embeddings"))


@plans.add("kmeans_silhouette")
def kmeans_silhouette(s, d):
    return V.kmeans(table(s, d, "embeddings"), list(range(4, 13)))


@plans.add("term_stats", r"WITH t AS (SELECT doc_id, unnest(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')) AS term FROM documents), n AS (SELECT count(*) AS docs FROM documents), g AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM t GROUP BY term) SELECT term, df, tf, round(ln(1 + (docs - df + 0.5) / (df + 0.5)), 6) AS idf FROM g, n")
def term_stats(s, d):
    return I.term_stats(table(s, d, "documents"))


@plans.add("payload_rows")
def payload_rows(s, d):
    docs = table(s, d, "documents")
    return I.payloads(docs.drop("text"), K.chunk_documents(docs)).drop("text")
