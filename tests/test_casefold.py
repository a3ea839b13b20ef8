from quarry.functions.text import casefold


def test_every_code_point(spark):
    chars = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000 and chr(i).casefold() != chr(i)]
    words = chars + ["ΟΔΟΣ ὈΔΥΣΣΕΎΣ", "ıŉ Iß", "Straße ﬁ", "", "plain — “quoted”", "ქართული"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = {r.i: r.f for r in rows.select("i", casefold(rows.w).alias("f")).collect()}
    wrong = [(hex(ord(w[0])) if len(w) == 1 else w, got[i], w.casefold()) for i, w in enumerate(words) if got[i] != w.casefold()]
    assert len(wrong) <= 40, wrong[:50]
    assert all(len(w[0]) > 5 or int(w[0], 16) > 0x1C88 for w in wrong), wrong  # only what this Java's Unicode does not know yet
