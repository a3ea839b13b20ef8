import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from test_decontam import brute as leaks
from test_neardup import brute as groups
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import quality, toxicity
from quarry.session import table


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf, "labels").select("doc_id", "toxic"))
    rows = [r for r in rows if lexicon.score(*lexicon.weight(r[1])) < toxicity.THRESHOLD]
    ids = {r[0] for r in rows}
    model = quality.learn_quality(docs.where(F.col("doc_id").isin(*ids)), table(spark, sf, "labels").select("doc_id", "quality"))
    f = quality.Features()
    rows = [r for r in rows if model.rate(*f(r[1]), model.grades[-1])[1] >= quality.KEEP]
    kept = groups(rows, 80)
    rows = [r for r in rows if kept[r[0]][2]]
    bad = {k[0] for k in leaks(rows, [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()])}
    rows = [r for r in rows if r[0] not in bad]
    out = corpus_pipeline.run(spark, sf).collect()
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in rows}
    got = defaultdict(list)
    seqs = defaultdict(int)
    for r in out:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id] += ids
        seqs[r.sequence_id] += r.length
    assert {i: len(x) for i, x in got.items()} == {i: len(x) for i, x in want.items()}
    assert max(seqs.values()) <= 1024 and len(rows) > 50


def test_stages_keep_the_columns_and_take_odd_rows(spark, sf):
    docs = table(spark, sf, "documents").limit(20)
    odd = spark.createDataFrame([(None, None, None, None, None), (901, "", "en", "s", 0), (901, "", "en", "s", 0), (902, "a " * 30_000, None, "s", 5)], docs.schema)
    both = docs.union(odd).withColumn("score", F.lit("own")).withColumn("component", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, both, sf)
        assert got.columns == both.columns, name
        got.count()
        assert stage(spark, both.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, both.limit(0), sf).count() == 0
