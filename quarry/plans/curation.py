"""Queries over corpus curation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import corpus as C
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()

#: The generated documents are clean, so damage is added by rule before it is looked for.
DAMAGED = "CASE doc_id % 10 WHEN 1 THEN concat(text, chr(1), chr(2)) WHEN 2 THEN concat('data:image/png;base64,AAAA ', text) WHEN 3 THEN substr(text, 1, 20) WHEN 4 THEN repeat('�', 40) WHEN 5 THEN '' WHEN 6 THEN concat('data:application/pdf;base64,QUJD', text) ELSE text END"
STRIPPED = r"regexp_replace(regexp_replace(regexp_replace(t, 'data:image/[A-Za-z0-9.+-]+;base64,[A-Za-z0-9+/=]+', '[image]', 'g'), 'data:[A-Za-z0-9.+-]+/[A-Za-z0-9.+-]+;base64,[A-Za-z0-9+/=]+', '[file]', 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x{80}-\x{9F}]', '', 'g')"
DAMAGE_CTE = f"""
raw AS (SELECT doc_id, source, {DAMAGED} AS t FROM documents),
b AS (SELECT *, {STRIPPED} AS body FROM raw),
m AS (SELECT *, length(regexp_replace(body, '\\s', '', 'g')) AS meaningful, length(body) - length(replace(body, '�', '')) AS bad, CASE WHEN length(body) = 0 THEN 0::DOUBLE ELSE (length(body) - length(replace(body, '�', '')))::DOUBLE / length(body) END AS ratio FROM b),
dmg AS (SELECT *, CASE WHEN meaningful = 0 THEN 'empty_body' WHEN meaningful < 30 THEN 'near_empty' WHEN ratio >= 0.01 THEN 'mojibake' END AS reason FROM m)
"""


def _damaged(s, d):
    return table(s, d, "documents").selectExpr("doc_id", "source", f"{DAMAGED} AS text")


@plans.add("hygiene_report", f"WITH {DAMAGE_CTE} SELECT doc_id, length(t)::INT AS raw_length, length(body)::INT AS length, meaningful::INT AS meaningful, 0 AS nul_chars, (length(t) - length(regexp_replace(t, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{{80}}-\\x{{9F}}]', '', 'g')))::INT AS control_chars, bad::INT AS replacement_chars, round(ratio, 6) AS replacement_ratio, len(regexp_extract_all(t, 'data:[A-Za-z0-9.+-]+/[A-Za-z0-9.+-]+;base64,[A-Za-z0-9+/=]+'))::INT AS data_uris, reason FROM dmg")
def hygiene_report(s, d):
    return C.hygiene_report(_damaged(s, d))


@plans.add("quarantine_split", f"WITH {DAMAGE_CTE} SELECT doc_id, source, reason FROM dmg WHERE reason IS NOT NULL")
def quarantine_split(s, d):
    return C.split_quarantine(_damaged(s, d))[1].select("doc_id", "source", "reason")


@plans.add("clean_text", f"WITH {DAMAGE_CTE} SELECT doc_id, sha256(nfc_normalize(body)) AS body_hash FROM dmg")
def clean_text(s, d):
    return _damaged(s, d).select("doc_id", T.content_hash(T.clean_text(F.col("text"))).alias("body_hash"))


@plans.add("corpus_profile", f"WITH {DAMAGE_CTE} SELECT source, count(*) AS raw, count(DISTINCT t) AS unique_bodies, count(*) FILTER (reason IS NULL) AS clean, count(*) FILTER (reason = 'empty_body') AS empty_body, count(*) FILTER (reason = 'near_empty') AS near_empty, count(*) FILTER (reason = 'mojibake') AS mojibake, 0::BIGINT AS nul_docs, count(*) FILTER (regexp_matches(t, '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{{80}}-\\x{{9F}}]')) AS control_docs, sum(length(t))::BIGINT AS chars FROM dmg GROUP BY source")
def corpus_profile(s, d):
    return C.profile(_damaged(s, d))


@plans.add("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(s, d):
    return table(s, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


CLUSTERS = "SELECT sha256(text) AS cluster_key, count(*) AS size, min(doc_id) AS representative, count(*) > 40 AS suspect FROM documents GROUP BY 1 HAVING count(*) > 1"


@plans.add("exact_dup_clusters", CLUSTERS)
def exact_dup_clusters(s, d):
    return C.key_clusters(table(s, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("h")), "h")


@plans.add("exact_dup_members", f"WITH c AS ({CLUSTERS}) SELECT doc_id, cluster_key, representative FROM documents JOIN c ON sha256(text) = cluster_key")
def exact_dup_members(s, d):
    return C.exact_duplicates(table(s, d, "documents"))


@plans.add("cluster_stats", f"WITH c AS ({CLUSTERS}) SELECT count(*) AS clusters, coalesce(sum(size), 0)::BIGINT AS docs, coalesce(max(size), 0) AS largest, count(*) FILTER (suspect) AS suspects FROM c")
def cluster_stats(s, d):
    return C.cluster_stats(exact_dup_clusters(s, d))


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, source, regexp_extract_all(text, '\S+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, source, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s FROM (SELECT doc_id, source, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.source = b.source AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.85 * (x.n + y.n - c)),
r AS (SELECT a AS node, a AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a)
SELECT node AS doc_id, min(other) AS component FROM r GROUP BY node
"""


@plans.add("near_dup_clusters", NEAR_SQL)
def near_dup_clusters(s, d):
    return C.near_duplicate_clusters(table(s, d, "documents"))


@plans.add("markdown_tidy", r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text || chr(13) || chr(10) || '  ' || chr(10) || chr(10) || chr(10) || 'end ', '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS tidy FROM documents")
def markdown_tidy(s, d):
    return table(s, d, "documents").select("doc_id", T.plain_text_to_markdown(F.concat("text", F.lit("\r\n  \n\n\nend "))).alias("tidy"))


@plans.add("upsert_documents", "SELECT doc_id, text FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, upper(lang) AS text FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT -1 - doc_id, lang FROM documents WHERE doc_id % 7 = 0")
def upsert_documents(s, d):
    docs = table(s, d, "documents")
    new = docs.where("doc_id % 3 = 0").select("doc_id", F.upper("lang").alias("text")).union(docs.where("doc_id % 7 = 0").select(-1 - F.col("doc_id"), "lang"))
    return C.upsert(docs.select("doc_id", "text"), new, ["doc_id"])


@plans.add("stale_tail_delete", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN (SELECT o_orderkey, o_orderkey % 4 + 1 AS n FROM orders WHERE o_orderkey % 2 = 0) ON l_orderkey = o_orderkey WHERE n IS NULL OR l_linenumber - 1 < n")
def stale_tail_delete(s, d):
    chunks = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_linenumber") - 1).alias("chunk_index"))
    counts = table(s, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 4 + 1).alias("chunk_count"))
    return C.drop_stale_tail(chunks, counts, ["l_orderkey"]).drop("chunk_index")


@plans.add("latest_per_key", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_per_key(s, d):
    return C.latest_per_key(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@plans.add("schema_drift", """
SELECT key, count(*) AS rows, key = 'v' AS declared FROM (SELECT 'v' AS key FROM events WHERE event_id % 50 = 3 UNION ALL SELECT 'w' || user_id % 2 FROM events WHERE event_id % 70 = 5) GROUP BY key""")
def schema_drift(s, d):
    i = F.col("event_id")
    v, w = F.when(i % 50 == 3, ', "v": 1').otherwise(""), F.when(i % 70 == 5, F.concat(F.lit(', "w'), (F.col("user_id") % 2).cast("string"), F.lit('": 2'))).otherwise("")
    more = F.concat(F.regexp_replace("props", r"\}$", ""), v, w, F.lit("}"))
    return C.schema_drift(table(s, d, "events").withColumn("props", more), "props", ["k"], ["k", "v"])


def _versions(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(s, d, "orders")
    return o.select(F.col("o_custkey").alias("document_id"), F.col("o_orderkey").alias("version_id"), F.col("o_orderdate").alias("effective_from"), F.lead("o_orderdate").over(w).alias("effective_to"))


VERSIONS = "v AS (SELECT o_custkey AS document_id, o_orderkey AS version_id, o_orderdate AS effective_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to FROM orders)"


@plans.add("version_as_of", f"WITH {VERSIONS}, g AS (SELECT document_id, count(DISTINCT version_id) AS n, min(version_id) AS version_id, min(effective_from) AS effective_from FROM v WHERE effective_from <= TIMESTAMP '1996-06-01' AND (effective_to IS NULL OR effective_to > TIMESTAMP '1996-06-01') GROUP BY 1) SELECT document_id, CASE WHEN n = 1 THEN version_id END AS version_id, n > 1 AS ambiguous, CASE WHEN n = 1 THEN effective_from END AS effective_from FROM g")
def version_as_of(s, d):
    return C.versions_as_of(_versions(s, d), F.lit("1996-06-01").cast("timestamp_ntz"))


@plans.add("document_versions", f"WITH {VERSIONS} SELECT document_id, version_id, effective_from, row_number() OVER (PARTITION BY document_id ORDER BY effective_from DESC, version_id DESC)::INT AS position, effective_to IS NULL AS current FROM v")
def document_versions(s, d):
    w = Window.partitionBy("document_id").orderBy(F.desc("effective_from"), F.desc("version_id"))
    return _versions(s, d).select("document_id", "version_id", "effective_from", F.row_number().over(w).alias("position"), F.col("effective_to").isNull().alias("current"))


@plans.add("asof_join", "SELECT l.event_id, l.user_id, l.ts, r.value AS asof_value FROM (SELECT event_id, user_id, ts FROM events WHERE event_id % 2 = 1) l ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2) r ON l.user_id = r.user_id AND l.ts >= r.ts")
def asof_join(s, d):
    e = table(s, d, "events")
    right = e.where("event_id % 2 = 0").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return C.asof_join(e.where("event_id % 2 = 1").select("event_id", "user_id", "ts"), right, "user_id", "ts", "value")


@plans.add("uuid5_point_ids", "WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source || ':' || doc_id || ':0')) AS h FROM documents) SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || ['8', '9', 'a', 'b'][(('0x' || substr(h, 17, 1))::INT % 4) + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id FROM h")
def uuid5_point_ids(s, d):
    return table(s, d, "documents").select("doc_id", T.uuid5("6ba7b8119dad11d180b400c04fd430c8", F.concat_ws(":", "source", F.col("doc_id").cast("string"), F.lit("0"))).alias("point_id"))


@plans.add("row_identity", "SELECT doc_id, sha256(source || chr(0) || doc_id::VARCHAR || chr(0) || lang) AS identity, CASE WHEN length(text) = 0 THEN 0 ELSE len(regexp_extract_all(text, '\\S+')) END::INT AS words FROM documents".replace("\\\\", "\\"))
def row_identity(s, d):
    return table(s, d, "documents").select("doc_id", T.identity(F.col("source"), F.col("doc_id"), F.col("lang")).alias("identity"), T.word_count(F.col("text")).alias("words"))


@plans.add("canonical_json", "SELECT doc_id, to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'source': source})::VARCHAR AS json FROM documents")
def canonical_json(s, d):
    return table(s, d, "documents").select("doc_id", T.canonical_json("source", "n_chars", "doc_id", "lang").alias("json"))
