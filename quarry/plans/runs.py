"""Queries over crawl and ingestion runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import runs as R
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()


@plans.add("crawl_verdict", """
WITH c AS (SELECT user_id AS run, sum(CASE WHEN event_id % 50 = 0 THEN value > 100 END::INT) AS failures, sum(CASE WHEN user_id % 4 = 0 THEN CASE WHEN event_id % 50 = 1 THEN 0 END ELSE CASE WHEN event_id % 50 = 2 THEN 1 END END) AS exceptions FROM events GROUP BY 1),
t AS (SELECT user_id AS run, count(*) AS n, count(*) FILTER (event_id % 400 <> 0) AS done, count(*) FILTER (event_id % 400 = 1) AS bad FROM events WHERE event_type = 'view' GROUP BY 1),
r AS (SELECT DISTINCT user_id AS run FROM events),
j AS (SELECT run, list_filter([CASE WHEN run % 5 = 0 THEN 'finish_reason' END, CASE WHEN bad > 0 THEN 'reconciliation_failed' END, CASE WHEN done < n THEN 'not_finalized' END, CASE WHEN failures > 0 THEN 'quality_failures' END,
  CASE WHEN run % 6 = 1 THEN 'spider_errors' END, CASE WHEN exceptions > 0 THEN 'exceptions' END, CASE WHEN run % 7 = 1 THEN 'item_errors' END], lambda x: x IS NOT NULL) AS i FROM r LEFT JOIN c USING (run) LEFT JOIN t USING (run))
SELECT run, len(i) = 0 AS passed, array_to_string(i, ',') AS issues FROM j""")
def crawl_verdict(s, d):
    e, i, run = table(s, d, "events"), F.col("event_id"), F.col("user_id").alias("run")
    k = i % 50
    key = F.when(k == 0, "quality/failures").when((k == 1) & (F.col("user_id") % 4 == 0), "spider_exceptions/count").when(k == 2, "spider_exceptions/ValueError").otherwise("other")
    counters = e.select(run, key.alias("key"), F.when(k == 0, (F.col("value") > 100).cast("int")).when(k == 1, 0).otherwise(1).alias("value"))
    counters = counters.unionByName(e.where("user_id % 4 = 0").select(run, F.lit("spider_exceptions/count").alias("key"), F.lit(0).alias("value")).distinct())
    r = e.select(run).distinct().select("run", F.lit("finished").alias("expected"), F.when(F.col("run") % 5 == 0, F.lit(None)).otherwise("finished").alias("finish_reason"), (F.col("run") % 6 == 1).cast("int").alias("spider_errors"), (F.col("run") % 7 == 1).cast("int").alias("item_errors"))
    t = e.where("event_type = 'view'").select(run, i.alias("scope"), (i % 400 != 0).alias("finalized"), (i % 400 != 1).alias("ok"))
    return R.crawl_verdict(counters, r, t).withColumn("issues", F.array_join("issues", ","))


@plans.add("completion_rules", """
WITH r AS (SELECT o_orderkey AS run, o_orderdate AS a, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 1 DAY * ((o_custkey % 9)::INT - 1) END AS z FROM orders)
SELECT run, 'times_out_of_order' AS code FROM r WHERE z IS NULL OR z < a UNION ALL SELECT run, 'in_the_future' FROM r WHERE z > TIMESTAMP '1997-01-01'
UNION ALL SELECT run, 'failures' FROM r WHERE run % 10 = 0 UNION ALL SELECT run, 'not_reconciled' FROM r WHERE run % 11 = 3 UNION ALL SELECT run, 'item_count' FROM r WHERE run % 13 = 5""")
def completion_rules(s, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    r = table(s, d, "orders").select(
        k.alias("run"), day.alias("started"), F.when(k % 7 != 0, day + F.make_dt_interval((F.col("o_custkey") % 9).cast("int") - 1)).alias("finished"), F.lit(4).alias("items"),
        F.when(k % 13 == 5, 3).otherwise(4).alias("counted"), (k % 10 == 0).cast("int").alias("failures"), F.lit(2).alias("paginators"), F.when(k % 11 == 3, 1).otherwise(2).alias("reconciled"),
    )
    return R.completion_rules(r, F.lit("1997-01-01").cast("timestamp_ntz"))


@plans.add("quarantine_check", """
WITH l AS (SELECT user_id AS k, event_type AS t FROM events WHERE value > 200), x AS (SELECT DISTINCT user_id AS k, event_type AS t FROM events WHERE value > 190 AND user_id % 9 <> 0), u AS (SELECT k, t, count(*) AS n FROM l GROUP BY ALL)
SELECT k, t, 'listed_twice' AS code FROM u WHERE n > 1 UNION ALL SELECT k, t, 'not_excluded' FROM (SELECT k, t FROM u EXCEPT SELECT k, t FROM x) UNION ALL SELECT k, t, 'not_listed' FROM (SELECT k, t FROM x EXCEPT SELECT k, t FROM u)""")
def quarantine_check(s, d):
    e = table(s, d, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("t"), "value")
    return R.quarantine_check(e.where("value > 200"), e.where("value > 190 and k % 9 <> 0"), ["k", "t"])


@plans.add("schema_news", """
WITH i AS (SELECT event_id, event_type AS source, ['id', 'at'] || CASE WHEN event_id % 3 = 0 THEN ['x'] ELSE [] END || CASE WHEN event_id % 500 = 7 THEN ['y' || user_id % 3] ELSE [] END AS keys FROM events),
f AS (SELECT source, min(event_id) AS event_id FROM i GROUP BY 1), b AS (SELECT source, unnest(keys) AS key FROM i JOIN f USING (source, event_id)), k AS (SELECT source, unnest(keys) AS key FROM i)
SELECT source, key, count(*) AS items, key = 'x' AS declared FROM k WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source = k.source AND b.key = k.key) GROUP BY ALL""")
def schema_news(s, d):
    i = F.col("event_id")
    none = F.array().cast("array<string>")
    keys = F.concat(F.array(F.lit("id"), F.lit("at")), F.when(i % 3 == 0, F.array(F.lit("x"))).otherwise(none), F.when(i % 500 == 7, F.array(F.concat(F.lit("y"), (F.col("user_id") % 3).cast("string")))).otherwise(none))
    items = table(s, d, "events").select(F.col("event_type").alias("source"), i.alias("at"), keys.alias("keys"))
    one, base = R.schema_news(items.where("at % 2 = 0 or at < 100"), declared=["x"])  # two batches: the second meets the baseline of the first
    two, _ = R.schema_news(items.where("at % 2 = 1 and at >= 100"), base.join(one, ["source", "key"], "left_anti"), ["x"])
    return one.unionByName(two).groupBy("source", "key", "declared").agg(F.sum("items").alias("items"))


@plans.add("shard_resume", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS index FROM documents)
SELECT doc_id, index, (index % 8)::INT AS shard, index % 8 <> 5 AND index <= 300 + (index % 8) * 7 AS done FROM r""")
def shard_resume(s, d):
    docs = table(s, d, "documents").select("doc_id", (-F.col("doc_id")).alias("o"))
    cursors = s.range(8).where("id <> 5").select(F.col("id").cast("int").alias("shard"), (300 + F.col("id") * 7).alias("cursor"))
    return R.pending_of_shards(R.numbered(docs, ["o"]).drop("o"), cursors, 8)


@plans.add("claims_check", """
SELECT doc_id, 'not_acknowledged' AS code FROM documents WHERE doc_id % 6 = 0 UNION ALL SELECT doc_id, 'hash_differs' FROM documents WHERE doc_id % 6 <> 0 AND doc_id % 10 = 1 UNION ALL SELECT doc_id, 'count_differs' FROM documents WHERE doc_id % 6 <> 0 AND doc_id % 4 = 3""")
def claims_check(s, d):
    i = F.col("doc_id")
    docs = table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.ceil(F.col("n_chars") / 400).alias("chunks"))
    stored = docs.where("doc_id % 6 <> 0").select("doc_id", F.when(i % 10 == 1, "0").otherwise(F.col("hash")).alias("hash"), F.when(i % 4 == 3, F.col("chunks") + 1).otherwise(F.col("chunks")).alias("chunks"))
    return R.claims_check(docs, stored, "doc_id")


@plans.add("ingest_progress", """
WITH b AS (SELECT event_type, date_trunc('day', ts) AS at_, count(*) AS n, count(*) FILTER (value > 150) AS failed FROM events GROUP BY ALL), w AS (SELECT *, sum(n) OVER o AS done, sum(failed) OVER o AS failures, epoch(at_ - min(at_) OVER o) / 60 AS m FROM b WINDOW o AS (PARTITION BY event_type ORDER BY at_))
SELECT event_type, at_ AS at, done::BIGINT AS done, failures::BIGINT AS failures, CASE WHEN m > 0 THEN round(done / m, 4) END AS per_minute FROM w""")
def ingest_progress(s, d):
    b = table(s, d, "events").groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 150).alias("failed"))
    return R.progress(b, "event_type")


@plans.add("quarantine_pivot", """
WITH r AS (SELECT source, CASE WHEN n_chars < 200 THEN 'short' WHEN doc_id % 5 = 0 THEN 'control' ELSE 'other' END AS reason FROM documents)
SELECT source, count(*) FILTER (reason = 'short') AS short, count(*) FILTER (reason = 'control') AS control, count(*) AS total FROM r GROUP BY ROLLUP (source)""")
def quarantine_pivot(s, d):
    r = table(s, d, "documents").select("source", F.when(F.col("n_chars") < 200, "short").when(F.col("doc_id") % 5 == 0, "control").otherwise("other").alias("reason"))
    return R.reason_pivot(r, ["short", "control"])


@plans.add("text_matches", r"""
WITH w AS (SELECT item_id AS qid, unnest(list_distinct(list_filter(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+')[1:3], lambda x: length(x) BETWEEN 2 AND 30))) AS w FROM benchmark),
n AS (SELECT qid, count(*) AS n FROM w GROUP BY 1), d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}_]+'))) AS w FROM documents)
SELECT qid, doc_id FROM (SELECT qid, doc_id, count(*) AS got FROM w JOIN d USING (w) GROUP BY ALL) JOIN n USING (qid) WHERE got = n""")
def text_matches(s, d):
    from quarry.functions.text import tokens

    q = table(s, d, "benchmark").select(F.col("item_id").alias("qid"), F.array_join(F.slice(tokens(F.col("text")), 1, 3), " ").alias("text"))
    return R.text_matches(q, table(s, d, "documents"))


@plans.add("document_scroll", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 20 AND l_returnflag = 'A'")
def document_scroll(s, d):
    from quarry.operators.governance import filters

    c = table(s, d, "lineitem").withColumn("chunk_index", F.col("l_linenumber") - 1)
    return R.documents_only(c, filters(l_returnflag="A") & (F.col("l_quantity") > 20)).select("l_orderkey", "l_linenumber", "l_quantity")


@plans.add("snapshot_rows", "SELECT 'row' AS kind, doc_id FROM documents WHERE source = 'src1' AND doc_id % 2 = 1 UNION ALL SELECT 'foreign', doc_id FROM documents WHERE source <> 'src1'")
def snapshot_rows(s, d):
    docs = table(s, d, "documents").select("source", "doc_id")
    rows, foreign = R.snapshot_rows(docs, "src1", docs.where("doc_id % 2 = 1"))
    return rows.select(F.lit("row").alias("kind"), "doc_id").unionByName(foreign.select(F.lit("foreign").alias("kind"), "doc_id"))
