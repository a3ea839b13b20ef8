import json
import time

from pyspark.sql import functions as F

from quarry.streaming import ingest as S
from quarry.streaming.progress import ProgressLog
from quarry.streaming.retries import OUTPUT, last_states, track_retries

SCHEMA = "key long, id long, at timestamp, ok boolean"


def put(path, rows):
    path.write_text("".join(json.dumps(dict(zip(("key", "id", "at", "ok"), r, strict=True))) + "\n" for r in rows))


def test_attempts_timers_and_restarts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def drain():
        out = track_retries(S.file_stream(spark, str(src), SCHEMA), "1 minute", most=3, pause_ms=60_000)
        write = lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / "rows" / f"batch={n}"))
        out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    def rows():
        return spark.read.schema(OUTPUT).parquet(str(tmp_path / "rows"))

    at = lambda m: f"2024-01-01T00:{m:02}:00Z"
    put(src / "1.json", [(1, 2, at(2), False), (1, 1, at(1), True), (2, 3, at(0), False), (3, 4, at(0), False), (None, 5, at(0), False), (4, 6, at(1), None)])
    drain()
    assert {r.key: (r.status, r.attempts) for r in last_states(rows()).collect()} == {1: ("waiting", 1), 2: ("waiting", 1), 3: ("waiting", 1), 4: ("waiting", 1)}
    put(src / "2.json", [(2, 7, at(5), False), (3, 8, at(5), True)])  # a new run of the query: state comes from the checkpoint
    drain()
    put(src / "3.json", [(2, 9, at(20), False), (2, 10, at(21), True), (5, 11, at(40), True)])
    drain()
    got = {r.key: (r.status, r.attempts) for r in last_states(rows()).collect()}
    assert got[2] == ("dead", 3) and got[3] == ("done", 0) and got[5] == ("done", 0)  # what follows a death changes nothing
    due = {(r.key, r.attempts) for r in rows().where("kind = 'retry'").collect()}
    assert {(1, 1), (4, 1)} <= due and 5 not in {k for k, _ in due} and not {(2, 3), (3, 0)} & due


def test_progress_is_what_the_log_says(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.json").write_text("".join(json.dumps({"doc_id": 10 * i + j, "text": "t"}) + "\n" for j in range(i + 2)))
    log, job = ProgressLog(spark, str(tmp_path / "progress")), S.Ingest(spark, str(tmp_path / "out"))
    spark.streams.addListener(log)
    try:
        q = job.run(S.file_stream(spark, str(src), "doc_id long, text string"), str(tmp_path / "cp"))
        q.awaitTermination()
        until = time.time() + 30
        while not log.ended(str(q.runId)) and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    told = {r.batch: r.rows for r in log.read().where("batch is not null and rows > 0").collect()}
    done = {r.batch: r.n for r in job.log().groupBy("batch").agg(F.sum("n").alias("n")).collect()}
    assert told == done and sum(done.values()) == 9
    r = log.rates().first()
    assert r.rows == 9 and r.per_minute > 0
