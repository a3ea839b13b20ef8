"""Queries that run a stream over the events table to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.plans.base import Plans
from quarry.session import shared_dir, table
from quarry.streaming import ingest as S
from quarry.streaming.merge import MergeTable
from quarry.streaming.retries import OUTPUT, last_states, track_retries

plans = Plans()


def _stream(s, d):
    schema = table(s, d, "events").schema
    # a glob, as the file source wants a folder or a pattern
    return s.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


@plans.add("stream_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(s, d):
    out = S.windowed_counts(_stream(s, d), "ts", "1 hour", "1 minute", "event_type")
    return S.run_to_table(out, "complete").withColumn("start", F.col("start").cast("timestamp_ntz"))


@plans.add("stream_distinct_users", "SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct_users(s, d):
    out = S.distinct_stream(_stream(s, d).select("ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "400 days")
    return S.run_to_table(out).select("user_id", "event_type")


@plans.add("stream_upsert", "SELECT user_id AS doc_id, sha256(max(event_type)) AS hash FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING max(event_type) <> ''")
def stream_upsert(s, d):
    root = f"{shared_dir(s)}/quarry/stream-{uuid.uuid4().hex}"
    one = _stream(s, d).groupBy("user_id").agg(F.max("event_type").alias("text")).withColumnRenamed("user_id", "doc_id")
    job = S.Ingest(s, root)
    q = one.writeStream.outputMode("complete").foreachBatch(lambda df, n: job.batch(df, n)).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return job.documents().select("doc_id", "hash")


@plans.add("change_detection", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'added' WHEN doc_id % 4 = 1 THEN 'updated' ELSE 'unchanged' END AS change FROM documents")
def change_detection(s, d):
    docs = table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    known = docs.where("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 4 == 1, F.lit("old")).otherwise(F.col("hash")).alias("hash"))
    return S.detect_changes(docs, known, ["doc_id"]).select("doc_id", "change")


@plans.add("seen_filter", "SELECT event_id FROM events WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND user_id IS NOT NULL AND user_id % 2 = 0)")
def seen_filter(s, d):
    e = table(s, d, "events")
    return S.unseen(e, e.where("event_type = 'error' and user_id % 2 = 0"), ["user_id"]).select("event_id")


@plans.add("seen_upsert", "WITH r AS (SELECT user_id AS key, CASE WHEN event_id % 3 = 0 THEN 'success' ELSE 'incomplete' END AS outcome, event_id AS at_, sha256(event_type) AS h FROM events) SELECT key, arg_max(outcome, at_) AS outcome, max(CASE WHEN outcome = 'success' THEN at_ END) AS last_success, arg_max(h, at_) FILTER (outcome = 'success') AS content_hash, max(at_) AS at FROM r GROUP BY key")
def seen_upsert(s, d):
    e = table(s, d, "events")
    r = e.select(F.col("user_id").alias("key"), F.when(F.col("event_id") % 3 == 0, "success").otherwise("incomplete").alias("outcome"), F.col("event_id").alias("last_success"), F.sha2("event_type", 256).alias("content_hash"), F.col("event_id").alias("at"))
    known = S.merge_seen(r.limit(0), r.where("at % 2 = 0"))
    return S.merge_seen(known, r.where("at % 2 = 1"))


@plans.add("merge_on_read", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'second' ELSE 'first' END AS version FROM lineitem
WHERE NOT (l_orderkey % 4 = 1 AND l_linenumber > 2) AND NOT (l_orderkey % 7 = 2 AND l_linenumber = 1 AND l_orderkey % 3 <> 0)
GROUP BY ALL""")
def merge_on_read(s, d):
    """Order lines in three batches, one of them repeated: all, then every third order anew with deletes, then cut tails."""
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber")
    t = MergeTable(s, f"{shared_dir(s)}/quarry/merge-{uuid.uuid4().hex}", ["l_orderkey", "l_linenumber"], "l_orderkey long, l_linenumber int, version string", tail="l_linenumber")
    state = t.stage({}, 0, lines.withColumn("version", F.lit("first")))
    gone = lines.where("l_orderkey % 7 = 2 and l_linenumber = 1 and l_orderkey % 3 <> 0")
    for _ in range(2):
        state = t.stage(state, 1, lines.where("l_orderkey % 3 = 0").withColumn("version", F.lit("second")), gone)
    return t.read(t.stage(state, 2, tails=lines.where("l_orderkey % 4 = 1").select("l_orderkey", F.lit(3).alias("count"))))


@plans.add("stream_retries", """
WITH e AS (SELECT user_id AS key, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE user_id IS NOT NULL),
g AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY key ORDER BY n) AS ok FROM e),
r AS (SELECT *, CASE WHEN bad THEN row_number() OVER (PARTITION BY key, ok, bad ORDER BY n) ELSE 0 END AS run FROM g),
l AS (SELECT key, arg_max(run, n) AS run, coalesce(bool_or(run >= 3), false) AS dead FROM r GROUP BY key)
SELECT key, CASE WHEN dead THEN 'dead' WHEN run > 0 THEN 'waiting' ELSE 'done' END AS status, CASE WHEN dead THEN 3 ELSE run END AS attempts FROM l""")
def stream_retries(s, d):
    """Events as attempts of their users, errors as failures: three in a row are one too many. Attempts and timers are in the state store."""
    rows = _stream(s, d).select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").alias("at"), (F.col("event_type") != "error").alias("ok"))
    root = f"{shared_dir(s)}/quarry/stream-{uuid.uuid4().hex}"
    put = lambda df, n: df.write.mode("overwrite").parquet(f"{root}/rows/batch={n}")
    track_retries(rows, "400 days", 3).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return last_states(s.read.schema(OUTPUT).parquet(f"{root}/rows")).select("key", "status", "attempts")
