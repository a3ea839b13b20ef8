import unicodedata
import uuid

from pyspark.sql import functions as F

from quarry.functions import text as T


def test_damage_reasons(spark):
    rows = [(1, None), (2, "  \n"), (3, "x" * 29), (4, "x" * 30), (5, "a\x00\x01b" + "y" * 40), (6, "�" + "z" * 99), (7, "�" + "z" * 100), (8, "data:image/png;base64,AAAA")]
    got = {r.i: r for r in spark.createDataFrame(rows, "i int, t string").select("i", T.damage(F.col("t")).alias("d")).select("i", "d.*").collect()}
    assert [got[i].reason for i in range(1, 9)] == ["empty_body", "empty_body", "near_empty", None, None, "mojibake", None, "near_empty"]
    assert (got[5].nul_chars, got[5].control_chars, got[5].length) == (1, 2, 42) and got[8].data_uris == 1


def test_clean_text(spark):
    t = "é data:image/png;base64,AB== data:application/pdf;base64,QQ==\x07\tend"
    got = spark.createDataFrame([(t,), (None,)], "t string").select(T.clean_text(F.col("t")).alias("c")).collect()
    assert got[0].c == "é [image] [file]\tend" == unicodedata.normalize("NFC", got[0].c) and got[1].c is None


def test_tokens_shingles_jaccard(spark):
    df = spark.createDataFrame([("Straße ABC_1, ქართული!", "a b c d e f"), (None, "a b"), ("", "")], "t string, s string")
    got = df.select(T.tokens(F.col("t")).alias("t"), T.shingles(F.col("s")).alias("s"), T.word_count(F.col("s")).alias("n")).collect()
    assert got[0].t == ["strasse", "abc_1", "ქართული"] and got[1].t == [] and got[2].t == []
    assert sorted(got[0].s) == ["a b c d e", "b c d e f"] and got[1].s == ["a b"] and got[2].s == [] and [r.n for r in got] == [6, 2, 0]


def test_uuid5_equals_standard(spark):
    ns = uuid.NAMESPACE_URL
    names = ["", "a:1:0", "წყარო:7"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(T.uuid5(ns.hex, F.col("n")).alias("u")).collect()
    assert [r.u for r in got] == [str(uuid.uuid5(ns, n)) for n in names]


def test_canonical_json_keeps_nulls(spark):
    r = spark.createDataFrame([(1, None)], "b int, a string").select(T.canonical_json("b", "a").alias("j")).first()
    assert r.j == '{"a":null,"b":1}'
