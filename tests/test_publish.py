import pytest
from pyspark.sql import functions as F

from quarry.plans.cache import ResultCache
from quarry.sinks import publish as W


def test_alias_switches_checks_and_rolls_back(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for name, rows in (("g1", df), ("g2", df.where("k = 1")), ("g3", df)):
        W.publish({"t": rows}, root, name)
    a = W.Alias(spark, root)
    assert a.current() is None
    with pytest.raises(ValueError):
        a.rollback()
    a.switch("g1")
    a.switch("g2", smoke=lambda path: None if spark.read.parquet(f"{path}/t").count() == 1 else "wrong rows")
    assert W.Alias(spark, root).current() == "g2" and a.rollback() == "g1" and a.current() == "g1"
    with pytest.raises(ValueError, match="too few"):
        a.switch("g2", smoke=lambda path: "too few")
    df.union(df).write.mode("overwrite").parquet(f"{root}/g3/t")  # not as its manifest says
    assert W.verify(spark, root, "g3") == {"t": "rows differ"}
    with pytest.raises(ValueError):
        a.switch("g3")
    assert a.current() == "g1" and W.verify(spark, root, "g1") == {}


def test_digest_is_of_rows_and_not_of_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    d = W.table_digest(df)
    assert d == W.table_digest(df.select("v", "k").orderBy("v").repartition(3)) and d != W.table_digest(df.distinct())


def test_files_are_whole_and_logs_rotate(spark, tmp_path):
    p = str(tmp_path / "a.txt")
    W.write_text(spark, p, "one")
    W.write_text(spark, p, "two é")
    assert (tmp_path / "a.txt").read_text() == "two é" and not [x for x in tmp_path.iterdir() if x.name.endswith(".tmp")]
    log = str(tmp_path / "log")
    for i in range(6):
        W.append_rotating(spark, log, f"line {i}\n", most=14, backups=2)
    assert [(tmp_path / n).read_text().split() for n in ("log", "log.1", "log.2")] == [["line", "4", "line", "5"], ["line", "2", "line", "3"], ["line", "0", "line", "1"]]


def test_cache_expires_evicts_and_refuses():
    now = [0.0]
    c = ResultCache(2, 10.0, fit=lambda v: v != "degraded", clock=lambda: now[0])
    k = [ResultCache.key({"q": q, "k": 1}, "f", "g") for q in "abc"]
    assert k[0] == ResultCache.key({"k": 1, "q": "a"}, "f", "g") != ResultCache.key({"k": 1, "q": "a"}, "f", "h")
    c.put(k[0], 1)
    c.put(k[1], 2)
    assert c.get(k[0]) == 1
    c.put(k[2], 3)
    assert c.get(k[1]) is None and c.get(k[0]) == 1
    now[0] = 10.0
    assert c.get(k[0]) is None
    c.put(k[0], "degraded")
    assert c.get(k[0]) is None


def test_a_second_writer_is_told(spark, tmp_path):
    from quarry.operators.agreement import SeenStore
    from quarry.sinks.files import NameTaken
    from quarry.streaming.ingest import Ingest, Pointers

    a, b = Pointers(spark, str(tmp_path / "p")), Pointers(spark, str(tmp_path / "p"))
    a.put(0, {"x": 1})
    a.put(0, {"x": 1})  # its own repeat
    for p, content in ((b, {"x": 1}), (b, {"x": 2}), (a, {"x": 2})):
        with pytest.raises(NameTaken):
            p.put(0, content)
    assert b.current()["x"] == 1 and a.current()["writer"] == a.writer

    df = spark.createDataFrame([(1, "a")], "k int, v string")
    root = str(tmp_path / "g")
    for name in ("g1", "g2"):
        W.publish({"t": df}, root, name)
    one, two = W.Alias(spark, root), W.Alias(spark, root)
    with pytest.raises(NameTaken):  # another switch comes between the check and the pointer
        one.switch("g1", smoke=lambda _: two.switch("g2") or one.pointers.put(0, {"name": "g1"}))
    assert one.current() == "g2"

    seen = [SeenStore(spark, str(tmp_path / "s")) for _ in range(2)]
    rows = spark.createDataFrame([(1, "success", 5, "h", 5)], SeenStore.SCHEMA)
    for s, run in zip(seen, ("r1", "r2"), strict=True):
        s.stage(run, rows.withColumn("key", rows["key"] + int(run[1])))
    real = seen[0].pointers.put

    def late(number, content):
        seen[0].pointers.put = real
        seen[1].commit("r2")
        real(number, content)

    seen[0].pointers.put = late
    seen[0].commit("r1")
    assert sorted(r.key for r in seen[1].read().collect()) == [2, 3] and seen[0].pointers.current()["runs"] == ["r2", "r1"]

    jobs = [Ingest(spark, str(tmp_path / "i"), lambda d: d.withColumn("reason", F.lit(None).cast("string"))) for _ in range(2)]
    inner = jobs[0].check
    jobs[0].check = lambda d: (jobs[1].batch(spark.createDataFrame([(2, "b")], "doc_id long, text string"), 0), inner(d))[1]
    with pytest.raises(NameTaken):
        jobs[0].batch(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 0)
    assert [r.doc_id for r in jobs[0].documents().collect()] == [2]


def test_an_old_file_stays_when_the_rename_fails(spark, tmp_path, monkeypatch):
    from quarry.sinks import files

    p = str(tmp_path / "a.txt")
    W.write_text(spark, p, "one")
    with monkeypatch.context() as m:
        m.setattr(files, "move", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            W.write_text(spark, p, "two")
    assert (tmp_path / "a.txt").read_text() == "one"
    (tmp_path / "g").mkdir()
    df = spark.createDataFrame([(1,)], "k int")
    with monkeypatch.context() as m:  # a folder of that name appears after the check
        m.setattr(W, "exists", lambda *a: False)
        with pytest.raises(FileExistsError):
            W.publish({"t": df}, str(tmp_path), "g")
    assert list((tmp_path / "g").iterdir()) == [] and not [x for x in tmp_path.iterdir() if "staging" in x.name]
