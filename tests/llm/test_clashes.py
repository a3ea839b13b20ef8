"""Operators over tables that already have columns of the names they give."""

from quarry.llm import chat, decontam, packing, pitman_yor, registry, urls


def test_chat_rows_beside_columns_of_its_own_names(spark):
    call = '{"tool_calls":[{"id":"c1","name":"search","arguments":"{\\"query\\":\\"q\\"}"}]}'
    plain = [(1, 0, "user", "hi"), (1, 1, "assistant", call), (1, 2, "tool", '{"tool_call_id":"c1","content":"ok"}')]
    df = spark.createDataFrame(plain, "conv_id long, turn int, role string, text string")
    more = spark.createDataFrame([(*r, "k", "j", "c", 1) for r in plain], "conv_id long, turn int, role string, text string, kind string, json string, call_id string, problem int")
    rows = lambda d: sorted(map(str, chat.format_chat(d, registry.CHAT_TOOLS).collect()))
    assert rows(more) == rows(df)


def test_urls_replace_columns_of_their_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "h", "r", "v", "p"), (2, None, "h", "r", "v", "p")], "page_id long, url string, host string, rule string, verdict string, path string")
    out = urls.judge_urls(pages, registry.URL_RULES, spark.createDataFrame([], "a string, b string"))
    assert sorted(out.columns) == sorted(pages.columns)
    assert {tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()} == {(1, "a.net", "/x", "net/", "block"), (2, "", "", None, "allow")}


def test_language_model_ignores_other_columns(spark):
    texts = [(i, f"a b c d {i % 3} x y".encode(), i % 4 != 0) for i in range(40)] + [(None, None, True), (7, b"a b", True)]
    df = spark.createDataFrame(texts, "doc_id long, text binary, train boolean")
    more = spark.createDataFrame([(*t, "z", 1, 1.0) for t in texts], "doc_id long, text binary, train boolean, token string, n_tokens int, score double")
    got = [sorted(map(str, pitman_yor.score(d, pitman_yor.fit(d)).collect())) for d in (df, more)]
    assert got[0] == got[1] and len(got[0]) == 42


def test_packing_replaces_places_it_gave_before(spark):
    pieces = spark.createDataFrame([(i, 0, 100 + i % 5, i, 9, 9) for i in range(60)], "doc_id long, start long, length long, ids_crc32 long, sequence_id int, offset int")
    out = packing.pack(packing.pack(pieces))
    assert out.columns.count("sequence_id") == out.columns.count("offset") == 1 and out.count() == 60


def test_sharding_query_of_null_texts(spark, tmp_path):
    spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "é", None), (4, "x", "a")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in registry.op9_sharding(spark, str(tmp_path)).collect()}
    assert {i: (r["size"], r.text_crc32) for i, r in out.items()} == {1: (1, 0), 2: (1, 0), 3: (3, 235179326), 4: (2, 2363233923)}
    assert sorted(r.shard for r in out.values()) == [0, 1, 2, 3] and {r.slot for r in out.values()} == {0}


def test_items_beyond_the_broadcast_bound_are_joined(spark, sf, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(str, decontam.find_contamination(docs, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert sorted(map(str, decontam.find_contamination(docs, items).collect())) == want
