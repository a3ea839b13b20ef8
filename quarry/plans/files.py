"""Queries that write files to the shared folder and read them back: runs of raw items, ledgers, canonical lines, generations, logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions.chunking import chunk_documents
from quarry.functions.html import page_of
from quarry.plans.base import Plans
from quarry.session import shared_dir, table
from quarry.sinks import publish as W
from quarry.sources import jsonl as J

plans = Plans()


def _folder(s) -> str:
    return f"{shared_dir(s)}/quarry/files-{uuid.uuid4().hex}"


def _runs(s, d):
    """Two runs of items, the second with every other document only, damaged lines and blank ones."""
    root = _folder(s)
    docs = table(s, d, "documents").select("doc_id", "source")
    line = lambda run: F.when(F.col("doc_id") % 7 == run, "{broken").when(F.col("doc_id") % 7 == 6, " ").otherwise(F.to_json(F.struct("doc_id", F.concat("source", F.lit(f"/{run}")).alias("v"))))
    for run, rows in ((1, docs), (2, docs.where("doc_id % 2 = 0"))):
        rows.select(line(run).alias("value")).write.text(f"{root}/runs/r{run}")
    return J.read_items(s, f"{root}/runs/*", "doc_id long, v string")


@plans.add("jsonl_items", """
SELECT 'r' || run AS run, count(*) AS rows, count(*) FILTER (doc_id % 7 = run) AS malformed FROM documents, unnest([1, 2]) AS x(run) WHERE doc_id % 7 <> 6 AND (run = 1 OR doc_id % 2 = 0) GROUP BY run""")
def jsonl_items(s, d):
    m = J.malformed(_runs(s, d))
    return m.groupBy(F.regexp_extract("source_file", "/runs/([^/]+)/", 1).alias("run")).agg(F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"))


@plans.add("jsonl_newest", """
SELECT doc_id, source || CASE WHEN doc_id % 2 = 0 AND doc_id % 7 <> 2 THEN '/2' ELSE '/1' END AS v FROM documents WHERE doc_id % 7 <> 6 AND NOT (doc_id % 7 = 1 AND doc_id % 2 = 1)""")
def jsonl_newest(s, d):
    items = _runs(s, d).where("doc_id is not null")
    return J.newest_run(items, ["doc_id"]).select("doc_id", "v")


@plans.add("jsonl_primary", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'first' ELSE 'second' END AS root FROM documents")
def jsonl_primary(s, d):
    docs = table(s, d, "documents").select("doc_id")
    return J.primary_root([docs.where("doc_id % 3 = 0").withColumn("root", F.lit("first")), docs.withColumn("root", F.lit("second"))], ["doc_id"])


@plans.add("canonical_lines", """SELECT '{"doc_id":' || doc_id || ',"lang":' || CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '"' || lang || '"' END || ',"source":"' || source || '"}' AS value FROM documents""")
def canonical_lines(s, d):
    root = _folder(s)
    W.write_jsonl(table(s, d, "documents").select("source", F.when(F.col("doc_id") % 4 != 0, F.col("lang")).alias("lang"), "doc_id"), root, ["doc_id"])
    return s.read.text(root)


@plans.add("generation_switch", """
SELECT name, t AS "table", n AS rows, name = 'g2' AS current FROM (SELECT 'g1' AS name, 'docs' AS t, count(*) AS n FROM documents UNION ALL SELECT 'g2', 'docs', count(*) FILTER (doc_id % 2 = 0) FROM documents UNION ALL SELECT 'g1', 'users', count(DISTINCT user_id) FROM events UNION ALL SELECT 'g2', 'users', count(DISTINCT user_id) FROM events)""")
def generation_switch(s, d):
    root, docs = _folder(s), table(s, d, "documents").select("doc_id", "source")
    users = table(s, d, "events").select("user_id").distinct()
    alias, out = W.Alias(s, root), []
    for name, rows in (("g1", docs), ("g2", docs.where("doc_id % 2 = 0"))):
        out += [(name, t, m["rows"]) for t, m in W.publish({"docs": rows, "users": users}, root, name, {"docs": ["doc_id"]}).items()]
        alias.switch(name)
    return s.createDataFrame([(*r, r[0] == alias.current()) for r in out], "name string, `table` string, rows long, current boolean")


@plans.add("run_log", "SELECT doc_id, round(doc_id / 7.0, 4) AS score FROM documents")
def run_log(s, d):
    root = _folder(s)
    rows = table(s, d, "documents").select("doc_id", (F.col("doc_id") / 7.0).alias("score"))
    W.append_log(rows.where("doc_id % 2 = 0"), root, ["score"])
    W.append_log(rows.where("doc_id % 2 = 1"), root, ["score"])
    return s.read.schema("doc_id long, score double").json(root)


@plans.add("chunk_failures", """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'empty_body' WHEN doc_id % 9 = 1 THEN 'blank_body' END AS failure, doc_id % 9 > 1 AND regexp_matches(text, '\\S') AS chunked FROM documents""")
def chunk_failures(s, d):
    """The whole corpus chunked; documents that give no chunk are recorded with the reason and not raised."""
    i = F.col("doc_id")
    docs = table(s, d, "documents").select("doc_id", F.when(i % 9 == 0, F.lit(None)).when(i % 9 == 1, " \n\t").otherwise(F.col("text")).alias("text"))
    has = chunk_documents(docs).groupBy(F.col("doc_id").alias("__doc")).agg(F.count("*").alias("chunks"))
    why = F.when(F.col("text").isNull(), "empty_body").when(~F.col("text").rlike(r"\S"), "blank_body")
    return docs.join(has, i == F.col("__doc"), "left").select("doc_id", why.alias("failure"), F.col("chunks").isNotNull().alias("chunked"))


@plans.add("page_faults", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '# ' || url || chr(10) || chr(10) || 'open head' WHEN 1 THEN '| a | ' || page_id || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| a | c\\|d |' WHEN 2 THEN '# ' || page_id || chr(10) || chr(10) || 'x² **b**' ELSE '' END AS markdown, CASE WHEN page_id % 8 = 3 THEN 'AssertionError: unknown status keyword ''foo'' in marked section' END AS fault FROM pages""")
def page_faults(s, d):
    """Pages built by rule (an open head, spans in a table, section tables, nothing, markup that breaks the parser), so that the Markdown is known."""
    p, i = table(s, d, "pages"), F.col("page_id").cast("string")
    k = F.col("page_id") % 4
    html = (
        F.when(k == 0, F.concat(F.lit("<html><head><title>t</title><meta charset=utf-8><body><h1>"), F.col("url"), F.lit("</h1><p>open   head")))
        .when(k == 1, F.concat(F.lit("<table><tr><td rowspan=2>a</td><td>"), i, F.lit("</td></tr><tr><td>c|d</td></tr></table>")))
        .when(k == 2, F.concat(F.lit('<table id="HEADER:1;_Content"><tr><td>'), i, F.lit("</td></tr></table><p>x<sup>2</sup> <b>b</b><script>no()</script>")))
        .when(F.col("page_id") % 8 == 3, F.concat(F.lit("<p>"), i, F.lit("<![foo[x]]>")))
    )
    return p.select("page_id", page_of(html, F.lit("")).alias("m")).select("page_id", "m.*")


@plans.add("chunk_budgets", """
WITH w AS (SELECT doc_id, (doc_id % 57 + 1)::INT AS n FROM documents), c AS (SELECT doc_id, n, i, n // 10 AS full_, n % 10 AS rest FROM w, unnest(range(0, 6)) AS x(i) WHERE i < n // 10 OR (i = n // 10 AND n % 10 > 0)),
p AS (SELECT doc_id, i, CASE WHEN i < full_ THEN i * 10 + 1 WHEN full_ = 0 THEN 1 ELSE full_ * 10 - least(2, 10 - rest) + 1 END AS a, CASE WHEN i < full_ THEN i * 10 + 10 ELSE n END AS z FROM c)
SELECT doc_id, i::INT AS chunk_index, z - a + 1 AS token_count, array_to_string(list_transform(range(a, z + 1), lambda k: 'w' || k), ' ') AS text FROM p""")
def chunk_budgets(s, d):
    """Bodies of numbered words in chunks of ten with an overlap of two: every boundary is known."""
    words = F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 57 + 1).cast("int")), lambda k: F.concat(F.lit("w"), k.cast("string")))
    docs = table(s, d, "documents").select("doc_id", F.array_join(words, " ").alias("text"))
    return chunk_documents(docs, 10, 2, 3).select("doc_id", "chunk_index", "token_count", "text")


@plans.add("chunk_long_words", """
SELECT doc_id, i::INT AS chunk_index, repeat('x', CASE WHEN n <= 8 THEN n WHEN i = 0 THEN n // 2 ELSE n - n // 2 END) AS text
FROM (SELECT doc_id, (doc_id % 16 + 1)::INT AS n, unnest([0, 1]) AS i FROM documents) WHERE i = 0 OR n > 8""")
def chunk_long_words(s, d):
    """One long word a body, counted by its letters: more than the budget of eight is halved."""
    docs = table(s, d, "documents").select("doc_id", F.repeat(F.lit("x"), (F.col("doc_id") % 16 + 1).cast("int")).alias("text"))
    return chunk_documents(docs, 8, 0, 0, cost=len).select("doc_id", "chunk_index", "text")
