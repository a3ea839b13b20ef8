import datetime
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.operators import lexical
from quarry.operators import retrieval as R
from quarry.operators.governance import named_filter
from quarry.plans.engine import Engine


def corpus(spark, n=300):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(200)]
    text = lambda: " ".join([*rnd.choices(words, [1 / (i + 1) for i in range(200)], k=rnd.randrange(1, 60)), "all"])
    rows = [(i, text(), rnd.choice(["de", "en", None]), rnd.choice(["s1", "s2"]), datetime.date(2020, 1, 1) + datetime.timedelta(rnd.randrange(300))) for i in range(n)] + [(n, None, "de", "s1", None), (n + 1, "", "en", "s2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, date date")
    queries = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 9)))) for i in range(30)] + [(99, "all all"), (98, "unknown"), (97, None)], "qid long, text string")
    return docs.repartition(5), queries


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("seeds", [1, 40])
def test_skipping_changes_no_row(spark, monkeypatch, seeds):
    monkeypatch.setattr(lexical, "SEEDS", seeds)
    docs, queries = corpus(spark)
    ix = R.LexicalIndex(docs, ["lang", "source", "date"])
    for k in (7,) if seeds > 1 else (1, 400):
        assert same(R.bm25(ix, queries, k), R.bm25(docs.na.fill(""), queries, k)) and same(R.sparse(ix, queries, k), R.sparse(docs, queries, k))
    assert R.bm25(ix, queries, 0).count() == 0
    german = ix.allowed(F.col("lang") == "de")
    ids = {r.doc_id for r in docs.where("lang = 'de'").collect()}
    full = [r for r in R.bm25(docs.na.fill(""), queries, 1000).collect() if r.doc_id in ids]
    got = {(r.qid, r.doc_id): r.rank for r in ix.search(queries, 5, "bm25", german).collect()}
    want = {}
    for q in {r.qid for r in full}:
        for i, r in enumerate(sorted((r for r in full if r.qid == q), key=lambda r: r.rank)[:5]):
            want[q, r.doc_id] = i + 1
    assert got == want


def test_postings_read_are_a_part_and_a_common_term_is_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEEDS", 50)
    docs, queries = corpus(spark, 3000)
    ix = R.LexicalIndex(docs, ["source"])
    out, cost = ix.search_with_cost(queries.where("qid < 90"), 3)
    read, of = cost.agg(F.sum("read"), F.sum("of")).first()
    assert out.count() == 90 and read < 0.6 * of
    monkeypatch.setattr(lexical, "RUN_BITS", 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    runs = R.LexicalIndex(docs, []).postings.where("term = 'all'").groupBy(F.input_file_name()).count().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert runs > 1
    one = ix.opened(spark.createDataFrame([("w3",)], "term string"))
    opened = lambda d: d.select(F.input_file_name()).distinct().count()
    assert opened(one) < opened(ix.postings) and ix.postings.where("term = 'w3'").count() == one.where("term = 'w3'").count()
    empty = R.LexicalIndex(docs.limit(0), ["source"])
    assert empty.search(queries, 3).count() == 0 and empty.n == 0


def test_filters_by_name(spark):
    docs, queries = corpus(spark)
    wide = docs.withColumns({"status": F.lit("ok"), "parties": F.concat(F.lit("Smith & "), F.coalesce("lang", F.lit("x"))), "is_consolidated": F.col("doc_id") % 2 == 0, "effective_from": F.col("date"), "effective_to": F.when(F.col("doc_id") % 3 == 0, F.date_add("date", 10)), "document_id": F.col("doc_id").cast("string")})
    names = {"language": "lang"}
    columns = ["lang", "source", "date", "status", "parties", "is_consolidated", "effective_from", "effective_to", "document_id"]
    e, plain = Engine(wide, R.LexicalIndex(wide, columns, ["lang", "date"])), {r.doc_id: r for r in wide.collect()}
    day = datetime.date(2020, 5, 1)
    cases = {
        "language": ("de", lambda r: r.lang == "de"), "source": ("s1", lambda r: r.source == "s1"), "status": ("no", lambda r: False), "document_id": ("17", lambda r: r.doc_id == 17),
        "is_consolidated": (False, lambda r: r.doc_id % 2 == 1), "parties": ("smith DE", lambda r: r.lang == "de"), "contains": ("W0 all", lambda r: {"w0", "all"} <= set((r.text or "").split())),
        "date_from": ("2020-05-01", lambda r: r.date and r.date >= day), "date_to": ("2020-05-01", lambda r: r.date and r.date <= day),
        "as_of": ("2020-05-01", lambda r: r.date and r.date <= day and (r.effective_to is None or r.effective_to > day)),
    }
    for name, (value, fits) in cases.items():
        c, words = named_filter({name: value, "court": None, "clause_id": ""}, names)
        got = {r.doc_id for r in e.index.allowed(c, words).collect()}
        assert got == {i for i, r in plain.items() if fits(r)}, name
    both = {"language": "de", "date_from": "2020-05-01", "contains": "all"}
    hits = e.search(queries, 5, "reranked", named=both, columns=names).collect()
    assert hits and all(plain[r.doc_id].lang == "de" and plain[r.doc_id].date >= day for r in hits)
    with pytest.raises(ValueError, match="unknown"):
        named_filter({"colour": "red"})
    assert named_filter({}) == (None, None)


def test_no_text_is_read_under_filters(spark):
    docs, queries = corpus(spark)
    poison = docs.withColumns({"content_complete": F.col("doc_id") % 2 == 0, "effective_from": F.lit("2020-01-01").cast("date"), "effective_to": F.lit(None).cast("date")})
    index = R.LexicalIndex(poison, ["lang", "content_complete", "effective_from", "effective_to"])
    e = Engine(poison.withColumn("text", F.raise_error(F.lit("text was read")).cast("string")), index)
    assert e.search(queries, 3, "reranked", lang="de", max_per=("lang", 2)).count() > 0
    out = e.accurate(queries, queries.select("qid", F.lit(4).cast("long").alias("doc_id")), F.lit("2020-06-01").cast("date"), k=3)
    assert out.count() > 0 and out.where("doc_id % 2 = 1").count() == 0
    assert same(out, Engine(poison, index).accurate(queries, queries.select("qid", F.lit(4).cast("long").alias("doc_id")), F.lit("2020-06-01").cast("date"), k=3))


def test_blocks_are_columns_of_the_postings_files(spark):
    docs, _ = corpus(spark, 150)
    ix = R.LexicalIndex(docs, [])
    files = lambda d: {r[0] for r in d.select(F.input_file_name()).distinct().collect()}
    assert files(ix.blocks) == files(ix.postings)
    want = ix.postings.groupBy("term", "block").agg(F.count("*").alias("n"), F.max("tf").alias("most_tf"))
    assert same(want, ix.blocks.select("term", "block", "n", "most_tf"))


def test_lists_are_shuffled_once_and_not_once_a_query(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEEDS", 10)
    docs, _ = corpus(spark, 3000)
    rnd = random.Random(5)
    ix = R.LexicalIndex(docs, [])
    queries = spark.createDataFrame([(i, " ".join(f"w{rnd.randrange(40)}" for _ in range(12))) for i in range(200)], "qid long, text string")

    def shuffled(q):
        total = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
        before = total()
        assert q.count() * 5 == ix.search(q, 5).count()
        time.sleep(1)
        return total() - before

    assert shuffled(queries) < 4 * shuffled(queries.where("qid < 20"))


def test_tokens_are_not_shuffled_to_build_an_index(spark):
    docs, _ = corpus(spark, 3000)
    docs = docs.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 20))

    def shuffled():
        jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
        time.sleep(1)
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = shuffled()
    ix = R.LexicalIndex(docs, [])
    rows = shuffled() - before
    got = ix.lists.agg(F.count("*"), F.sum("n")).first()
    want = docs.select("doc_id", F.explode(F.split(F.trim("text"), " ")).alias("w")).where("w <> ''").groupBy("doc_id", "w").agg(F.count("*").alias("tf"))
    assert same(want.select("w", "doc_id", "tf"), ix.postings.select("term", "doc_id", "tf")) and got[1] == want.count()
    assert rows < got[0]


def test_a_term_in_most_documents_is_not_read_ahead_of_the_search(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEEDS", 10)
    docs, _ = corpus(spark, 3000)
    ix = R.LexicalIndex(docs, [])
    queries = spark.createDataFrame([(1, "all all w1"), (2, "all")], "qid long, text string")

    def shuffled():
        jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
        time.sleep(1)
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = shuffled()
    out = ix.search(queries, 5, "sparse")
    assert shuffled() - before < 1500
    assert same(out, R.sparse(docs, queries, 5))


@pytest.mark.parametrize("common", [0, 100, 100_000])
def test_lengths_of_vectors_shuffle_no_lists_of_common_terms(spark, monkeypatch, common):
    monkeypatch.setattr(lexical, "COMMON", common, raising=False)
    docs, _ = corpus(spark, 3000)
    ix = R.LexicalIndex(docs, [])

    def shuffled():
        jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
        time.sleep(1)
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = shuffled()
    got = {d: v for r in ix.norms.collect() for d, v in zip(r.ids, r.tf, strict=True)}
    assert common < 100_000 or shuffled() - before < 400_000
    df = {r.term: r.df for r in ix.terms.collect()}
    want = {}
    for r in ix.postings.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + (r.tf * math.log(1 + ix.n / df[r.term])) ** 2
    assert got.keys() == want.keys() and all(abs(got[i] - math.sqrt(want[i])) < 1e-9 for i in want)


def test_postings_are_sorted_by_one_number_and_tokens_not_at_all(spark, monkeypatch):
    docs, _ = corpus(spark, 150)
    sorts, kind = [], type(docs)
    was = kind.sortWithinPartitions
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda self, *a, **b: (sorts.append((a, dict(self.dtypes))), was(self, *a, **b))[1])
    ix = R.LexicalIndex(docs, ["source"])
    keys, types = sorts[-1]
    assert len(keys) == 1 and types[keys[0]] == "int"
    want = {r.doc_id: r.t for r in docs.select("doc_id", tokens(F.col("text")).alias("t")).collect()}
    assert {r.doc_id: r.t for r in ix.forward.select("doc_id", "t").collect()} == want and any(t != sorted(t) for t in want.values())
    assert not [f for f in ix.lists.schema if f.dataType.simpleString().startswith("array<struct")]
    got = [r for p in ix.lists.where("n > 1").collect() for r in zip(p.ids, p.dl, p.tf, strict=True)]
    plain = {r.doc_id: r.t for r in ix.forward.select("doc_id", "t").collect()}
    assert got and all(len(plain[i]) == dl for i, dl, _ in got)
