import json

import pytest
from pyspark.sql import functions as F

from quarry.sources import jsonl as J
from quarry.streaming import ingest as S


def put(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_stream_upserts_retries_and_restarts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put(src / "1.json", [{"doc_id": 1, "text": "a"}, {"doc_id": 2, "text": "poison"}, {"doc_id": 3, "text": "c"}])
    check = lambda d: d.withColumn("reason", F.when(F.col("text") == "poison", "bad text"))
    job = S.Ingest(spark, str(tmp_path / "out"), check)

    def drain():
        job.run(S.file_stream(spark, str(src), "doc_id long, text string"), str(tmp_path / "cp")).awaitTermination()

    drain()
    assert {r.doc_id: r.text for r in job.documents().collect()} == {1: "a", 3: "c"}
    for i in range(2, 6):
        put(src / f"{i}.json", [{"doc_id": 1, "text": "a"}, {"doc_id": 3, "text": f"c{i}"}])
        drain()
    assert {r.doc_id: r.text for r in job.documents().collect()} == {1: "a", 3: "c5"}
    assert [(r.doc_id, r.attempts) for r in job.dead().collect()] == [(2, 5)] and job.retries().count() == 0
    log = {(r.batch, r.change): r.n for r in job.log().collect()}
    assert log[0, "added"] == 2 and log[1, "unchanged"] == 1 and log[1, "updated"] == 1 and log[1, "failed"] == 1
    before = job.version()
    job.batch(spark.createDataFrame([(9, "late")], "doc_id long, text string"), 0)  # a repeated batch changes nothing
    assert job.version() == before and job.documents().where("doc_id = 9").count() == 0


def test_a_crash_at_any_write_leaves_a_batch_that_can_be_repeated(spark, tmp_path, monkeypatch):
    check = lambda d: d.withColumn("reason", F.when(F.col("text") == "poison", "bad"))
    first = [(1, "a"), (2, "poison"), (None, "n"), (7, None)]
    second = [(1, "b"), (3, "c"), (4, "poison"), (None, "m")]
    schema = "doc_id long, text string"

    def state(job):
        return [sorted(map(str, t.collect())) for t in (job.documents(), job.retries(), job.dead(), job.log())]

    def run(root, at):
        job = S.Ingest(spark, root, check)
        job.batch(spark.createDataFrame(first, schema), 0)
        if at:
            seen, real, put = [0], type(spark.range(1).write).parquet, S.Pointers.put

            def crash(*a, **k):
                out = real(*a, **k) if a and not isinstance(a[0], S.Pointers) else None
                if str(tmp_path) in str(a):
                    seen[0] += 1
                    if seen[0] == at:
                        raise OSError("lost")
                return out

            with monkeypatch.context() as m:
                m.setattr(type(spark.range(1).write), "parquet", crash)
                if at == 4:
                    m.setattr(S.Pointers, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    job.batch(spark.createDataFrame(second, schema), 1)
            assert put is S.Pointers.put and S.Ingest(spark, root, check).version() == 0
            job = S.Ingest(spark, root, check)
        job.batch(spark.createDataFrame(second, schema), 1)
        return state(job)

    want = run(str(tmp_path / "plain"), 0)
    assert len(want[0]) == 4 and len(want[1]) == 2
    for at in (1, 2, 3, 4):
        assert run(str(tmp_path / f"crash{at}"), at) == want


def test_pauses_double_after_failures():
    waits, runs = [], iter(["no", "no", "ok", "no", "ok"])

    class Query:
        def awaitTermination(self):
            if next(runs) == "no":
                raise OSError("down")

    left = [10]

    def stop():
        left[0] -= 1
        return left[0] <= 0 or len(waits) == 5

    assert S.keep_watching(Query, stop, waits.append, pause=5, most=12) == 3 and waits == [10, 12, 5, 10]


def test_an_unset_shared_folder_is_refused_on_a_cluster():
    from quarry.session import shared_dir

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Session)


def test_jsonl_sources(spark, tmp_path):
    for run, text in (("r1", "old"), ("r2", "new")):
        (tmp_path / "runs" / run).mkdir(parents=True)
        (tmp_path / "runs" / run / "items.jsonl").write_text(json.dumps({"id": "x", "t": text}) + "\n\n" + ("{broken\n" if run == "r2" else ""))
    items = J.read_items(spark, str(tmp_path / "runs" / "*"), "id string, t string")
    assert items.count() == 3 and {r.malformed for r in J.malformed(items).collect()} == {0, 1}
    assert [r.t for r in J.newest_run(items.where("id is not null"), ["id"]).collect()] == ["new"]
    (tmp_path / "c.jsonl").write_text("# note\n\n" + json.dumps({"id": "q"}) + "\n")
    assert [r.id for r in J.read_commented(spark, str(tmp_path / "c.jsonl"), "id string").collect()] == ["q"]
    put(tmp_path / "l.jsonl", [{"g": "one", "v": 1}])
    assert J.read_strict(spark, str(tmp_path / "l.jsonl"), "g string, v int", g="one").count() == 1
    with pytest.raises(Exception, match="differs"):
        J.read_strict(spark, str(tmp_path / "l.jsonl"), "g string, v int", g="two").collect()
    import hashlib

    sha = hashlib.sha256((tmp_path / "l.jsonl").read_bytes()).hexdigest()
    got = {r.file: r.state for r in J.attested_files(spark, str(tmp_path / "*.jsonl"), {"l.jsonl": sha, "c.jsonl": "0"}).collect()}
    assert got == {"l.jsonl": "ok", "c.jsonl": "changed"}
    a, b = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert sorted((r.k, r.v) for r in J.primary_root([a, b], ["k"]).collect()) == [(1, "a"), (2, "b")]


def test_windows_drop_late_rows(spark, tmp_path):
    src = tmp_path / "w"
    src.mkdir()
    put(src / "1.json", [{"ts": "2024-01-01T00:00:00Z", "value": 1.0}, {"ts": "2024-01-01T05:00:00Z", "value": 2.0}])
    s = S.file_stream(spark, str(src), "ts timestamp, value double")
    got = S.run_to_table(S.windowed_counts(s, "ts", "1 hour", "10 minutes", slide="30 minutes"), "complete")
    assert got.agg(F.sum("n")).first()[0] == 4
