"""Queries over integrity and listing operators: orders are the ledger, lineitem the rows it promises."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import governance as G
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()


def _ledger(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("doc"), (F.col("o_orderkey") % 5 + 1).alias("chunk_count"), (F.col("o_orderkey") % 97 == 0).alias("excluded"))
    points = table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") - 1).alias("chunk_index"), "l_partkey")
    return o, points.where("doc % 31 <> 0 or chunk_index <> 0")


LEDGER = "e AS (SELECT o_orderkey AS doc, o_orderkey % 5 + 1 AS chunk_count, o_orderkey % 97 = 0 AS excluded FROM orders), o AS (SELECT l_orderkey AS doc, l_linenumber - 1 AS i, l_partkey FROM lineitem WHERE l_orderkey % 31 <> 0 OR l_linenumber <> 1), g AS (SELECT doc, count(*) AS n, count(DISTINCT i) AS u, min(i) AS lo, max(i) AS hi FROM o GROUP BY doc), j AS (SELECT e.*, coalesce(n, 0) AS n, u, lo, hi FROM e LEFT JOIN g USING (doc))"


@plans.add("ledger_join", f"WITH {LEDGER} SELECT doc, 'missing_document' AS code FROM j WHERE NOT excluded AND n = 0 UNION ALL SELECT doc, 'chunk_count_mismatch' FROM j WHERE NOT excluded AND n > 0 AND n <> chunk_count UNION ALL SELECT doc, 'non_contiguous' FROM j WHERE NOT excluded AND n > 0 AND (lo <> 0 OR hi <> n - 1 OR u <> n) UNION ALL SELECT doc, 'excluded_has_points' FROM j WHERE excluded AND n > 0")
def ledger_join(s, d):
    return G.ledger_join(*_ledger(s, d), ["doc"], "chunk_index")


@plans.add("orphans", f"WITH {LEDGER} SELECT DISTINCT doc FROM o WHERE doc NOT IN (SELECT doc FROM e WHERE doc % 3 <> 0)")
def orphans(s, d):
    e, o = _ledger(s, d)
    return G.orphans(o, e.where("doc % 3 <> 0"), ["doc"])


@plans.add("sample_probe", "WITH s AS (SELECT o_orderkey * 2 AS doc, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 50 = 0), e AS (SELECT o_orderkey AS doc FROM orders), ob AS (SELECT o_orderkey AS doc, o_orderstatus AS ov FROM orders WHERE o_orderkey % 3 <> 0), j AS (SELECT s.doc, v, e.doc IS NOT NULL AS known, ov FROM s LEFT JOIN e USING (doc) LEFT JOIN ob USING (doc)) SELECT doc, 'unknown_document' AS code FROM j WHERE NOT known UNION ALL SELECT doc, 'sample_missing' FROM j WHERE known AND ov IS NULL UNION ALL SELECT doc, 'sample_mismatch' FROM j WHERE ov <> v")
def sample_probe(s, d):
    o = table(s, d, "orders")
    samples = o.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") * 2).alias("doc"), F.when(F.col("o_orderkey") % 4 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v"))
    return G.sample_probe(samples, o.select(F.col("o_orderkey").alias("doc")), o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("doc"), F.col("o_orderstatus").alias("v")), ["doc"], "v")


@plans.add("coverage_diff", "WITH u AS (SELECT DISTINCT source, doc_id FROM documents), h AS (SELECT DISTINCT source, doc_id + CASE WHEN doc_id % 50 = 0 THEN 1000000 ELSE 0 END AS doc_id FROM documents JOIN labels USING (doc_id)), x AS (SELECT DISTINCT source, doc_id FROM documents WHERE doc_id % 4 = 0), j AS (SELECT source, doc_id, u.doc_id IS NOT NULL AS inu, h.doc_id IS NOT NULL AS inh FROM u FULL JOIN h USING (source, doc_id)), k AS (SELECT j.*, x.doc_id IS NOT NULL AS inx FROM j LEFT JOIN x USING (source, doc_id)) SELECT source, count(*) FILTER (inu) AS universe, count(*) FILTER (inu AND inh) AS covered, count(*) FILTER (inu AND NOT inh AND inx) AS excused, count(*) FILTER (inu AND NOT inh AND NOT inx) AS missing, count(*) FILTER (inh AND NOT inu) AS extra FROM k GROUP BY source".replace("u.doc_id IS NOT NULL AS inu, h.doc_id IS NOT NULL AS inh FROM u FULL JOIN h", "inu IS NOT NULL AS inu, inh IS NOT NULL AS inh FROM (SELECT *, 1 AS inu FROM u) u FULL JOIN (SELECT *, 1 AS inh FROM h) h").replace("x.doc_id IS NOT NULL AS inx FROM j LEFT JOIN x", "inx IS NOT NULL AS inx FROM j LEFT JOIN (SELECT *, 1 AS inx FROM x) x"))
def coverage_diff(s, d):
    docs = table(s, d, "documents").select("source", "doc_id")
    have = docs.join(table(s, d, "labels"), "doc_id").select("source", (F.col("doc_id") + F.when(F.col("doc_id") % 50 == 0, 1_000_000).otherwise(0)).alias("doc_id"))
    return G.coverage(docs, have, docs.where("doc_id % 4 = 0"), ["doc_id"], "source")


@plans.add("delta_completeness", "WITH c AS (SELECT l_orderkey AS doc, l_linenumber - 1 AS i, CASE WHEN l_orderkey % 9 = 0 AND l_linenumber = 2 THEN 1 ELSE 2 END AS v FROM lineitem WHERE l_orderkey % 11 <> 0 OR l_linenumber <> 1), z AS (SELECT doc, max(v) AS cv FROM c WHERE i = 0 GROUP BY doc), g AS (SELECT doc, count(*) FILTER (v = cv) AS n, count(DISTINCT CASE WHEN v = cv THEN i END) AS u, max(CASE WHEN v = cv THEN i END) AS hi, count(*) FILTER (v <> cv) AS other, max(cv) AS cv FROM c LEFT JOIN z USING (doc) GROUP BY doc) SELECT doc, 'no_first_chunk' AS code FROM g WHERE cv IS NULL UNION ALL SELECT doc, 'incomplete' FROM g WHERE u <> n OR hi <> n - 1 UNION ALL SELECT doc, 'stale_version' FROM g WHERE other > 0")
def delta_completeness(s, d):
    c = table(s, d, "lineitem").where("l_orderkey % 11 <> 0 or l_linenumber <> 1")
    c = c.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") - 1).alias("i"), F.when((F.col("l_orderkey") % 9 == 0) & (F.col("l_linenumber") == 2), 1).otherwise(2).alias("v"))
    return G.delta_completeness(c, ["doc"], "i", "v")


@plans.add("newest_matching_run", "WITH c AS (SELECT user_id AS doc, event_id AS run, event_type AS hash FROM events), w AS (SELECT user_id AS doc, CASE WHEN user_id % 5 = 0 THEN 'none' ELSE min(event_type) END AS want FROM events GROUP BY 1), j AS (SELECT doc, run, hash = want AS matched FROM c JOIN w USING (doc)) SELECT doc, run, matched FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY matched DESC, run DESC) AS n FROM j) WHERE n = 1")
def newest_matching_run(s, d):
    e = table(s, d, "events")
    c = e.select(F.col("user_id").alias("doc"), F.col("event_id").alias("run"), F.col("event_type").alias("hash"))
    want = c.groupBy("doc").agg(F.min("hash").alias("hash")).withColumn("hash", F.when(F.col("doc") % 5 == 0, "none").otherwise(F.col("hash")))
    return G.newest_matching(c, want, ["doc"], "run")


FRESH = """
WITH i AS (SELECT event_type AS source, count(*) AS total, count(*) FILTER (value > 1) AS complete FROM events WHERE event_type <> 'click' GROUP BY 1),
o AS (SELECT event_type AS source, max(ts) AS last_seen, count(*) FILTER (user_id = 7) AS errors FROM events WHERE event_type <> 'view' GROUP BY 1),
s AS (SELECT DISTINCT event_type AS source, 24 AS max_age_hours, 9000 AS min_basis_points FROM events WHERE event_type <> 'error'),
j AS (SELECT * FROM s FULL JOIN i USING (source) FULL JOIN o USING (source))
SELECT source, 'no_sla' AS code FROM j WHERE max_age_hours IS NULL UNION ALL SELECT source, 'no_inventory' FROM j WHERE total IS NULL UNION ALL SELECT source, 'no_observation' FROM j WHERE last_seen IS NULL
UNION ALL SELECT source, 'stale' FROM j WHERE last_seen < TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 24 HOUR AND max_age_hours IS NOT NULL UNION ALL SELECT source, 'coverage' FROM j WHERE complete * 10000 < total * min_basis_points UNION ALL SELECT source, 'errors' FROM j WHERE errors > 0
"""


@plans.add("freshness_audit", FRESH)
def freshness_audit(s, d):
    e = table(s, d, "events").withColumnRenamed("event_type", "source")
    inv = e.where("source <> 'click'").groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("value") > 1).alias("complete"))
    obs = e.where("source <> 'view'").groupBy("source").agg(F.max("ts").alias("last_seen"), F.count_if(F.col("user_id") == 7).alias("errors"))
    sla = e.where("source <> 'error'").select("source").distinct().withColumns({"max_age_hours": F.lit(24), "min_basis_points": F.lit(9000)})
    return G.freshness(inv, obs, sla, F.lit("2024-01-31 12:00:00").cast("timestamp_ntz"))


@plans.add("retention_plan", "SELECT o_orderkey AS run, CASE WHEN o_orderkey % 50 = 0 THEN 'protected' WHEN o_orderkey % 41 = 0 THEN 'missing' WHEN o_orderstatus = 'F' THEN 'failed' WHEN o_orderdate > TIMESTAMP '1997-01-01' THEN 'future' WHEN o_custkey % 7 = 0 THEN 'not_covered' WHEN o_orderdate > TIMESTAMP '1997-01-01' - to_days(CASE WHEN o_custkey % 2 = 0 THEN 30 ELSE 180 END) THEN 'too_young' ELSE 'prune' END AS verdict FROM orders")
def retention_plan(s, d):
    o = table(s, d, "orders")
    runs = o.select(F.col("o_orderkey").alias("run"), (F.col("o_orderkey") % 50 == 0).alias("protected"), F.when(F.col("o_orderkey") % 41 != 0, F.col("o_orderdate")).alias("finished"), (F.col("o_orderstatus") != "F").alias("ok"), (F.col("o_custkey") % 7 != 0).alias("covered"), F.when(F.col("o_custkey") % 2 == 0, 30).otherwise(180).alias("days"))
    return G.retention(runs, F.lit("1997-01-01").cast("timestamp_ntz"), F.col("days")).select("run", "verdict")


@plans.add("field_diff", "WITH e AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer), a AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 THEN lower(c_name) ELSE c_name END AS name, CASE WHEN c_custkey % 15 <> 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 20 <> 1), l AS (SELECT k, 'name' AS field, name AS expected FROM e UNION ALL SELECT k, 'segment', segment FROM e), r AS (SELECT k, 'name' AS field, name AS actual FROM a UNION ALL SELECT k, 'segment', segment FROM a) SELECT k, field, expected, actual FROM l FULL JOIN r USING (k, field) WHERE expected IS DISTINCT FROM actual")
def field_diff(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    a = c.where("k % 20 <> 1").select("k", F.when(F.col("k") % 10 == 0, F.lower("name")).otherwise(F.col("name")).alias("name"), F.when(F.col("k") % 15 != 0, F.col("segment")).alias("segment"))
    return G.field_diff(c, a, "k", ["name", "segment"])


PAGES = """
WITH p AS (SELECT user_id % 40 AS scope, user_id // 40 AS page, list(event_id % 700) AS ids, CASE WHEN user_id % 40 = 3 THEN max(user_id) ELSE 250 + user_id % 40 END AS total, user_id // 40 = 3 AS terminal FROM events WHERE user_id % 40 <> 5 OR user_id > 60 GROUP BY user_id
  UNION ALL SELECT DISTINCT 7, 9, []::BIGINT[], 257, true FROM events),
i AS (SELECT scope, count(*) AS seen, count(DISTINCT id) AS u FROM (SELECT scope, unnest(ids) AS id FROM p) GROUP BY scope),
g AS (SELECT scope, count(*) AS pages, count(DISTINCT total) AS totals, arg_max(total, page) AS total, count(*) FILTER (len(ids) = 0) AS empty, arg_max(terminal, page) AS terminal FROM p GROUP BY scope)
SELECT scope, pages, coalesce(seen, 0) AS seen, coalesce(u, 0) AS "unique", array_to_string(list_filter([CASE WHEN totals > 1 THEN 'total_drift' END, CASE WHEN u <> total THEN 'count_mismatch' END, CASE WHEN empty > 0 AND u < total THEN 'early_empty' END, CASE WHEN NOT terminal THEN 'no_terminal' END, CASE WHEN seen - u > 0.2 * seen THEN 'duplicate_rate' END], lambda x: x IS NOT NULL), ',') AS codes FROM g LEFT JOIN i USING (scope)
"""


@plans.add("pagination_reconcile", PAGES)
def pagination_reconcile(s, d):
    e = table(s, d, "events").where("user_id % 40 <> 5 or user_id > 60")
    p = e.groupBy("user_id").agg(F.collect_list(F.col("event_id") % 700).alias("ids"))
    u = F.col("user_id")
    p = p.select((u % 40).alias("scope"), F.floor(u / 40).alias("page"), "ids", F.when(u % 40 == 3, u).otherwise(250 + u % 40).alias("advertised_total"), (F.floor(u / 40) == 3).alias("terminal"))
    one = s.createDataFrame([(7, 9, [], 257, True)], p.schema)
    return G.pagination(p.unionByName(one))


@plans.add("split_leakage", "SELECT user_id, count(DISTINCT split) AS splits FROM (SELECT user_id, CASE WHEN event_id % 7 = 0 THEN event_id % 3 ELSE user_id % 3 END AS split FROM events) GROUP BY user_id HAVING count(DISTINCT split) > 1")
def split_leakage(s, d):
    split = F.when(F.col("event_id") % 7 == 0, F.col("event_id") % 3).otherwise(F.col("user_id") % 3)
    return G.split_leakage(table(s, d, "events").withColumn("split", split), "user_id", "split")


@plans.add("holdout_antijoin", "SELECT item_id FROM benchmark WHERE item_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def holdout_antijoin(s, d):
    return table(s, d, "benchmark").join(table(s, d, "labels").where("quality = 1"), F.col("item_id") == F.col("doc_id"), "left_anti").select("item_id")


@plans.add("set_hash", "WITH m AS (SELECT source, sha256(doc_id::VARCHAR) AS h FROM (SELECT DISTINCT source, doc_id FROM documents)) SELECT source, count(*) AS members, " + " || '-' || ".join(f"sum(('0x' || substr(h, {i * 8 + 1}, 8))::HUGEINT)::VARCHAR" for i in range(4)) + " AS digest FROM m GROUP BY source")
def set_hash(s, d):
    return G.set_hash(table(s, d, "documents"), "source", "doc_id")


@plans.add("lookup", "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2') AND n_chars >= 500 AND n_chars <= 4000 AND list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), 'the')".replace("\\\\", "\\"))
def lookup(s, d):
    return table(s, d, "documents").where(G.filters(lang="en", source__in=["src1", "src2"], n_chars__from=500, n_chars__to=4000, text__text="the", doc_id=None)).select("doc_id", "lang", "source", "n_chars")


@plans.add("browse_page", "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, source, doc_id LIMIT 20 OFFSET 40")
def browse_page(s, d):
    return G.browse(table(s, d, "documents").select("doc_id", "source", "n_chars"), [F.desc("n_chars"), F.col("source"), F.col("doc_id")], 40, 20)


@plans.add("facet_counts", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)")
def facet_counts(s, d):
    return table(s, d, "documents").rollup("source", "lang").agg(F.count("*").alias("n"))


@plans.add("dedup_documents", "SELECT l_orderkey, min(l_linenumber) AS first_line, arg_min(l_partkey, {'a': l_linenumber, 'b': l_partkey}) AS partkey, count(*) AS chunks FROM lineitem GROUP BY l_orderkey")
def dedup_documents(s, d):
    li = table(s, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("first_line"), F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("partkey"), F.count("*").alias("chunks"))


@plans.add("refresh_due", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 100")
def refresh_due(s, d):
    return table(s, d, "orders").where(F.col("o_orderdate") <= F.lit("1996-01-01").cast("timestamp_ntz")).orderBy("o_orderdate", "o_orderkey").limit(100).select("o_orderkey", "o_orderdate")


@plans.add("neighbor_context", "SELECT conv_id, turn, lag(text) OVER w AS before, lead(text) OVER w AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def neighbor_context(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(s, d, "conversations").select("conv_id", "turn", F.lag("text").over(w).alias("before"), F.lead("text").over(w).alias("after"))
