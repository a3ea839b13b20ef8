"""Queries of the ten operators and the pipeline, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import chat, collocations, decontam, mixing, neardup, packing, pitman_yor, quality, sharding, simhash, toxicity, urls, whitening
from quarry.session import materialize, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair in which the document holds at least 80 % of the item's shingles."""
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH iw AS (SELECT item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
ik AS (SELECT *, least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
ish AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM ik)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ish GROUP BY item_id),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
dk AS (SELECT doc_id, w, k FROM dw, (SELECT DISTINCT k FROM ik) WHERE len(w) >= k),
dsh AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM dk)),
hit AS (SELECT doc_id, item_id, count(*) AS shared FROM dsh JOIN ish USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, shared, shared::DOUBLE / n_shingles AS containment FROM hit JOIN n USING (item_id) WHERE shared * 100 >= n_shingles * 80
"""

CHAT_TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"], "additionalProperties": False},
    "fetch": {"properties": {"url": {"type": "string"}}, "required": ["url"], "additionalProperties": False},
    "calculate": {"properties": {"expression": {"type": "string"}, "precision": {"type": "integer"}}, "required": ["expression"]},
}


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as canonical JSON rows, with tool calls linked, ordered and validated."""
    return chat.format_chat(table(spark, sf_dir, "conversations"), CHAT_TOOLS)


#: The generated conversations hold no tool markup, so on them every row is a message; tests/llm/test_chat.py covers calls.
OP2_SQL = """
SELECT conv_id, turn, 'message' AS kind, NULL::VARCHAR AS call_id, turn AS order_turn, 0 AS order_level, 0 AS order_part, 0 AS order_item, NULL::VARCHAR AS problem,
  to_json({'content': text, 'role': role, 'turn': turn})::VARCHAR AS json
FROM conversations
"""

#: Derived tool calls: a turn in three calls a tool after the call three turns before, the next one answers it, the third speaks.
CHAT_CALLS = r"""
CASE WHEN turn % 3 = 0 THEN to_json(named_struct('tool_calls', transform(sequence(0, CASE WHEN conv_id % 7 = 3 THEN 1 ELSE 0 END), i -> named_struct(
  'id', concat('c', turn), 'name', CASE WHEN turn % 2 = 0 THEN 'search' ELSE 'calculate' END,
  'arguments', CASE WHEN turn % 2 = 1 THEN to_json(named_struct('precision', 2)) WHEN conv_id % 4 = 1 THEN to_json(named_struct('query', 'q', 'limit', 'x')) ELSE to_json(named_struct('query', 'q', 'limit', turn)) END,
  'after', CASE WHEN conv_id % 5 = 0 AND turn = 0 THEN array('c3') WHEN turn >= 3 THEN array(concat('c', turn - 3)) ELSE array() END))))
WHEN turn % 3 = 1 THEN to_json(named_struct('tool_call_id', CASE WHEN conv_id % 6 = 5 THEN concat('x', turn) ELSE concat('c', turn - 1) END, 'content', 'ok'))
ELSE text END
"""


def chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose turns are made into chained, doubled, circular and unanswered calls: linking, order and validation at work."""
    turns = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "CASE WHEN turn % 3 = 1 THEN 'tool' ELSE role END AS role", f"{CHAT_CALLS} AS text")
    return chat.format_chat(turns, CHAT_TOOLS)


CHAT_CALLS_SQL = """
WITH t AS (SELECT conv_id, turn, role, text, turn % 3 AS k FROM conversations),
has3 AS (SELECT DISTINCT conv_id FROM t WHERE turn = 3),
calls AS (SELECT t.conv_id, turn, i, CASE WHEN turn % 2 = 0 THEN 'search' ELSE 'calculate' END AS name, conv_id % 5 = 0 AND has3.conv_id IS NOT NULL AS cycle,
  EXISTS (SELECT 1 FROM t r WHERE r.conv_id = t.conv_id AND r.turn = t.turn + 1 AND t.conv_id % 6 <> 5) AS answered
  FROM t LEFT JOIN has3 USING (conv_id), unnest(CASE WHEN conv_id % 7 = 3 THEN [0, 1] ELSE [0] END) AS x(i) WHERE k = 0)
SELECT conv_id, turn, 'message' AS kind, NULL::VARCHAR AS call_id, turn AS order_turn, 0 AS order_level, 0 AS order_part, 0 AS order_item, NULL::VARCHAR AS problem,
  to_json({'content': text, 'role': role, 'turn': turn})::VARCHAR AS json FROM t WHERE k = 2
UNION ALL
SELECT conv_id, turn, 'call', 'c' || turn, turn, CASE WHEN cycle THEN 0 ELSE turn // 3 END, 1, i,
  nullif(array_to_string(list_filter([CASE WHEN i > 0 THEN 'duplicate id' END, CASE WHEN cycle AND i = 0 THEN 'cycle' END, CASE WHEN NOT answered THEN 'no result' END,
    CASE WHEN name = 'calculate' THEN 'missing expression' WHEN conv_id % 4 = 1 THEN 'limit is not integer' END], lambda x: x IS NOT NULL), '; '), ''),
  '{"arguments":' || CASE WHEN name = 'calculate' THEN '{"precision":2}' WHEN conv_id % 4 = 1 THEN '{"limit":"x","query":"q"}' ELSE '{"limit":' || turn || ',"query":"q"}' END || ',"id":"c' || turn || '","name":"' || name || '","turn":' || turn || '}'
FROM calls
UNION ALL
SELECT t.conv_id, t.turn, 'result', CASE WHEN t.conv_id % 6 = 5 THEN 'x' || t.turn ELSE 'c' || (t.turn - 1) END, coalesce(c.turn, t.turn), CASE WHEN c.turn IS NULL OR c.cycle THEN 0 ELSE c.turn // 3 END, 2, 0,
  CASE WHEN c.turn IS NULL THEN 'no call' END,
  '{"content":"ok","role":"tool","tool_call_id":"' || CASE WHEN t.conv_id % 6 = 5 THEN 'x' || t.turn ELSE 'c' || (t.turn - 1) END || '","turn":' || t.turn || '}'
FROM t LEFT JOIN calls c ON c.conv_id = t.conv_id AND c.turn = t.turn - 1 AND c.i = 0 AND t.conv_id % 6 <> 5 WHERE t.k = 1
"""

URL_RULES = [urls.Rule("block", "net"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the four rules; pages without a rule take the decision of their aliases."""
    pages = table(spark, sf_dir, "pages")
    out = urls.judge_urls(pages.select("page_id", "url"), URL_RULES, urls.page_links(pages))
    return out.select("page_id", "host", "path", "rule", "verdict")


#: Says what the pages' markup asks for: dot segments, ``<base>`` and default ports (none in them) are left to tests/llm/test_urls.py.
OP3_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^#]*)', 1, 's') AS rest
  FROM pages),
links AS (
  SELECT host || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END AS a,
    CASE WHEN t LIKE '%://%' THEN t WHEN t LIKE '//%' THEN 'http:' || t WHEN t LIKE '/%' THEN 'http://' || host || t WHEN t LIKE '?%' THEN 'http://' || host || path || t
      ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1, 's') END || t END AS t
  FROM (SELECT *, unnest(list_concat(
    list_transform(regexp_extract_all(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'), lambda x: regexp_extract(x, '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'is')),
    list_transform(regexp_extract_all(html, '<meta\b[^>]*\bproperty\s*=\s*["'']?og:url\b[^>]*>', 0, 'is'), lambda x: regexp_extract(x, '\bcontent\s*=\s*["'']?([^"''\s>]+)', 1, 'is')),
    list_transform(regexp_extract_all(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'), lambda x: regexp_extract(x, '\burl\s*=\s*[''"]?([^"''\s>]+)', 1, 'is')))) AS t FROM p) WHERE t <> '' AND host <> ''),
ends AS (
  SELECT a, translate(regexp_extract(t, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS bh, regexp_extract(t, '^.*?://[^/?#]*([^#]*)', 1, 's') AS br FROM links WHERE t IS NOT NULL),
edges AS (SELECT a, bh || CASE WHEN br LIKE '/%' THEN br ELSE '/' || br END AS b FROM ends WHERE bh <> ''),
twoway AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS node, a AS other FROM twoway UNION SELECT r.node, b.b FROM reach r JOIN twoway b ON r.other = b.a),
rules(rh, rp, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
spread AS (
  SELECT node, CASE WHEN bool_or(action = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM (
    SELECT r.node, (SELECT arg_max(action, length(rh || rp)) FROM rules WHERE (split_part(split_part(r.other, '/', 1), '?', 1) = rh OR ends_with(split_part(split_part(r.other, '/', 1), '?', 1), '.' || rh)) AND starts_with(regexp_extract(r.other, '^[^/]*([^?]*)', 1, 's'), rp)) AS action FROM reach r)
  WHERE action IS NOT NULL GROUP BY node),
ruled AS (
  SELECT page_id, host, path, rest, (SELECT arg_max(struct_pack(n := rh || rp, v := action), length(rh || rp)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS r FROM p)
SELECT page_id, host, path, r.n AS rule, coalesce(r.v, s.verdict, 'allow') AS verdict
FROM ruled LEFT JOIN spread s ON r IS NULL AND host <> '' AND s.node = host || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END
"""


def url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' urls with derived redirects: each page but every fifth leads to the one seven ids on, so verdicts spread along chains."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    to = pages.select((F.col("page_id") - 7).alias("page_id"), F.col("url").alias("to"))
    edges = pages.where("page_id % 5 <> 0").join(to, "page_id").select(urls.node_of(F.col("url")).alias("a"), urls.node_of(F.col("to")).alias("b"))
    return urls.judge_urls(pages, URL_RULES, edges).select("page_id", "host", "path", "rule", "verdict")


def _alias_sql() -> str:
    head, rest = OP3_SQL.split("links AS (", 1)
    node = "x.host || CASE WHEN x.rest LIKE '/%' THEN x.rest ELSE '/' || x.rest END"
    edges = f"edges AS (SELECT {node} AS a, {node.replace('x.', 'y.')} AS b FROM p x JOIN p y ON y.page_id = x.page_id + 7 WHERE x.page_id % 5 <> 0 AND x.host <> '' AND y.host <> ''),\n"
    return head + edges + "twoway AS (" + rest.split("twoway AS (", 1)[1]


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of those outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.learn_lexicon(docs, labels.where(toxicity.fold_of(F.col("doc_id"), 4) != 2).select("doc_id", "toxic"))
    out = toxicity.score_toxicity(docs.select("doc_id", "text"), lexicon)
    held = F.coalesce(toxicity.fold_of(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """256-bit fingerprints of all documents, of an edited form of each and its likeness to that and to its neighbour."""
    return simhash.edited_likeness(table(spark, sf_dir, "documents"))


def simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint, the least fingerprint within reach and the number of different fingerprints within 8 of 256 bits."""
    fps = materialize(simhash.fingerprints(table(spark, sf_dir, "documents")), "fps")
    pairs, members = simhash.near_fingerprints(fps, 8)
    return simhash.linked_classes(pairs, members)


def hamming_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of customer keys, as 64-bit fingerprints, within two bits: blocks that all of them share are compared in parts."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.lpad(F.lower(F.hex("c_custkey")), 16, "0").alias("fingerprint"))
    return simhash.near_fingerprints(keys, 2, 64)[0]


HAMMING_SQL = "SELECT lpad(lower(hex(a.c_custkey)), 16, '0') AS a, lpad(lower(hex(b.c_custkey)), 16, '0') AS b, bit_count(xor(a.c_custkey, b.c_custkey))::BIGINT AS distance FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey AND bit_count(xor(a.c_custkey, b.c_custkey)) <= 2"


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchical Pitman-Yor log10 probabilities of all documents, learned from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(toxicity.fold_of(F.col("doc_id"), 5) == 1, F.lit(False))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), (~held).alias("train"))
    model = pitman_yor.fit(rows)
    out = pitman_yor.score(rows, model)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a shingle similarity of 0.85."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, w, least(len(w), 5) AS k FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM k)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a AS node, a AS other FROM link UNION SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a),
comp AS (SELECT node, min(other) AS c FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id, w.doc_id = coalesce(comp.c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.node = w.doc_id
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of all documents, learned outside the held-out fold, and which of them the selection keeps."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels.where(toxicity.fold_of(F.col("doc_id"), 5) != 3))
    out = quality.score_quality(docs.select("doc_id", "text"), model)
    held = F.coalesce(toxicity.fold_of(F.col("doc_id"), 5) == 3, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= quality.KEEP).alias("kept"))


def quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three grades, so that two ordered cuts are fitted: unfit, fit and short, fit and of 1,000 code points or more."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    graded = docs.select("doc_id", "n_chars").join(labels, "doc_id").select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("n_chars") < 1000, 1).otherwise(2).alias("grade"))
    model = quality.learn_quality(docs, graded.where(toxicity.fold_of(F.col("doc_id"), 5) != 3), "grade")
    out = quality.score_quality(docs.select("doc_id", "text"), model)
    held = F.coalesce(toxicity.fold_of(F.col("doc_id"), 5) == 3, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "expected_grade", "tail_probability")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 whose row counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.assign_shards(rows, ["doc_id", "size", "text_crc32"], 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 1024 ids."""
    import public_tokenizers as P

    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of 2 to 4 words by the score of their weakest cut."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, g, count(*) AS f FROM (SELECT lang, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS r(k))) GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM g WHERE len(g) > 1),
s AS (SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score FROM c JOIN g x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN g y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
i AS (SELECT lang, g[x:x + m - 1] AS g, max(f) AS longer FROM (SELECT lang, g, f, m, unnest(range(1, len(g) - m + 2)) AS x FROM (SELECT lang, g, f, unnest(range(2, len(g))) AS m FROM g WHERE len(g) > 2)) GROUP BY ALL),
o AS (SELECT b.*, array_to_string(g, ' ') AS phrase FROM b LEFT JOIN i USING (lang, g) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) QUALIFY rank <= 2000
"""


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix takes whose sources weigh 5, 2, 1 in turn and come to 150 % of all words."""
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix_sources(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mix_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mix, but within a source documents labelled as good are twice as likely: unequal inclusion probabilities."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("weight", F.lit(2.0))
    rows = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")).join(good, "doc_id", "left").fillna(1.0, ["weight"])
    out = mixing.mix_sources(rows, weight="weight")
    return out.select("doc_id", "size", "source_size", "target", "taken")


#: The walk takes each document that still fits, in rank order; the operator stops it 1,000 documents after the first that does not.
MIX_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size, {weight} AS w FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, coalesce(sum(size) FILTER (w = 1), 0)::BIGINT AS s1, coalesce(sum(size) FILTER (w = 2), 0)::BIGINT AS s2 FROM d GROUP BY source),
c AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, 2.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][place % 3 + 1] AS sw FROM c),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / sw, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(sw) OVER (ORDER BY cap / sw, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
t AS (SELECT *, least(cap, coalesce((SELECT min(struct_pack(a := cap / sw, b := place, c := level)) FROM l WHERE level * sw <= cap).c * sw, cap)) AS target FROM l),
f AS (SELECT *, CASE WHEN target <= s1 + 2.0 * s2 THEN coalesce(target / nullif(s1 + 2.0 * s2, 0), 0) WHEN s1 > 0 THEN (target - 2.0 * s2) / s1 ELSE 2 END AS factor FROM t),
r AS (
  SELECT doc_id, size, place, source_size, target, floor(least(2.0::DOUBLE, factor * w))::BIGINT AS whole, least(2.0::DOUBLE, factor * w) - floor(least(2.0::DOUBLE, factor * w)) AS p,
    (('0x' || substr(md5('mix/' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
ranked AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN row_number() OVER (PARTITION BY place, p > 0 AND size > 0 ORDER BY u / (1 - u) * ((1 - p) / p)) END AS k FROM r),
goals AS (SELECT place, any_value(target) - sum(whole * size) AS goal FROM ranked GROUP BY place),
walk AS (
  SELECT place, 0::BIGINT AS k, goal::DOUBLE AS lack, false AS got FROM goals
  UNION ALL SELECT x.place, x.k, CASE WHEN x.size <= lack THEN lack - x.size ELSE lack END, x.size <= lack FROM walk JOIN ranked x ON x.place = walk.place AND x.k = walk.k + 1)
SELECT doc_id, size, source_size, target, size * (whole + coalesce(got, false)::BIGINT) AS taken FROM ranked LEFT JOIN walk USING (place, k)
"""

def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along the 16 leading components of the distinct vectors' covariance, each with unit variance."""
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings")).drop("residual")


QUERIES = {"op1_decontamination": op1_decontamination, "op2_chat_format": op2_chat_format, "chat_tool_calls": chat_tool_calls, "op3_url_filter": op3_url_filter, "url_aliases": url_aliases, "op4_toxicity": op4_toxicity, "op5_simhash": op5_simhash, "simhash_links": simhash_links, "hamming_links": hamming_links, "op6_language_model": op6_language_model, "op7_near_duplicates": op7_near_duplicates, "op8_quality": op8_quality, "quality_grades": quality_grades, "op9_sharding": op9_sharding, "op10_packing": op10_packing, "op11_collocations": op11_collocations, "op12_mixing": op12_mixing, "mix_preferred": mix_preferred, "op13_whitening": op13_whitening, "pipeline": corpus_pipeline.run}
ORACLE = {"op1_decontamination": OP1_SQL, "op2_chat_format": OP2_SQL, "chat_tool_calls": CHAT_CALLS_SQL, "op3_url_filter": OP3_SQL, "url_aliases": _alias_sql(), "hamming_links": HAMMING_SQL, "op7_near_duplicates": OP7_SQL, "op11_collocations": OP11_SQL, "op12_mixing": MIX_SQL.format(weight="1"), "mix_preferred": MIX_SQL.format(weight="CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 2 ELSE 1 END")}
