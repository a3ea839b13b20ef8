"""Queries over the columns of ``functions.records`` and ``functions.masking``: inputs are built by rule, so the SQL states what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import masking as M
from quarry.functions import parse as P
from quarry.functions import records as R
from quarry.functions import text as T
from quarry.plans.base import Plans
from quarry.session import table

plans = Plans()


@plans.add("ratio_bounds", """
SELECT o_orderkey, CASE WHEN b = 0 THEN NULL ELSE round(least(a::DOUBLE / b, 1), 8) END AS ratio, b > 0 AND a * 10000 >= b * 2500 AS at_least, b > 0 AND a * 10000 <= b * 7500 AS at_most
FROM (SELECT o_orderkey, o_custkey % 50 AS a, o_orderkey % 40 AS b FROM orders)""")
def ratio_bounds(s, d):
    a, b = F.col("o_custkey") % 50, F.col("o_orderkey") % 40
    return table(s, d, "orders").select("o_orderkey", R.ratio(a, b).alias("ratio"), R.meets_minimum(a, b, 2500).alias("at_least"), R.meets_maximum(a, b, 7500).alias("at_most"))


STAMPS = "CASE o_orderkey % 6 WHEN 0 THEN concat({t}, 'Z') WHEN 1 THEN concat({t}, '+04:30') WHEN 2 THEN concat({t}, '-01:00') WHEN 3 THEN {t} WHEN 4 THEN 'noon' ELSE concat(' ', {t}, 'Z') END"


@plans.add("utc_timestamps", """
SELECT o_orderkey, CASE WHEN k = 0 THEN t END AS strict, CASE k WHEN 0 THEN t WHEN 1 THEN t - INTERVAL 270 MINUTE WHEN 2 THEN t + INTERVAL 60 MINUTE WHEN 5 THEN t END AS utc
FROM (SELECT o_orderkey, o_orderkey % 6 AS k, o_orderdate::DATE + INTERVAL (o_orderkey % 86400) SECOND AS t FROM orders)""")
def utc_timestamps(s, d):
    t = F.date_format(F.col("o_orderdate").cast("date").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss")
    o = table(s, d, "orders").withColumn("t", t)
    o = o.withColumn("raw", F.expr(STAMPS.format(t="t")))
    return o.select("o_orderkey", R.utc_strict(F.col("raw")).alias("strict"), R.utc_of(F.col("raw")).alias("utc"))


@plans.add("field_cleaners", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || '.pdf' ELSE source END AS value, CASE WHEN doc_id % 4 <> 0 THEN lang END AS tag,
  CASE WHEN doc_id % 2 = 0 THEN lang || ' გადაწყვეტილება' END AS decision, CASE WHEN doc_id % 5 = 0 THEN lang WHEN doc_id % 5 = 1 THEN lang || ' ' || source WHEN doc_id % 5 = 2 THEN NULL ELSE source END AS name
FROM documents""")
def field_cleaners(s, d):
    i, source, lang = F.col("doc_id"), F.col("source"), F.col("lang")
    value = F.when(i % 3 == 0, F.concat(F.lit("C:\\FakePath\\"), source, F.lit(".pdf "))).otherwise(F.concat(F.lit("  "), source, F.lit(" ")))
    xml = F.when(i % 4 == 0, F.concat(F.lit("<other>"), lang, F.lit("</other>"))).otherwise(F.concat(F.lit("<a/><kind>\n "), lang, F.lit(" </kind><kind>x</kind>")))
    title = F.when(i % 2 == 0, F.concat(F.lit(" "), lang, F.lit("\n\n გადაწყვეტილება № 7"))).otherwise(lang)
    first = F.when(i % 5 < 2, lang).when(i % 5 == 2, "")
    last = F.when(i % 5 == 0, "").when(i % 5 == 2, F.lit(None)).otherwise(source)
    return table(s, d, "documents").select("doc_id", R.clean_value(value).alias("value"), R.xml_tag(xml, "kind").alias("tag"), R.decision_type(title).alias("decision"), R.full_name(first, last).alias("name"))


@plans.add("form_fields", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'A=own|B=x.pdf|-=' || o_orderpriority ELSE 'A=' || o_orderpriority || '|B=x.pdf' END AS fields,
  CASE WHEN o_orderkey % 3 = 0 THEN 'own' WHEN o_orderkey % 2 = 0 THEN 'asked' END AS request, CASE WHEN o_orderkey % 4 = 0 THEN 'first' ELSE 'c' || o_custkey END AS parcel
FROM orders""")
def form_fields(s, d):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    sets = F.array(F.struct(F.array(F.struct(F.lit(1).alias("id"), F.lit(" A ").alias("label")), F.struct(F.lit(2).alias("id"), F.lit("old").alias("label"))).alias("fields")), F.struct(F.array(F.struct(F.lit(2).alias("id"), F.lit("B").alias("label")), F.struct(F.lit(4).alias("id"), F.lit("the მოთხოვნის ტექსტი").alias("label"))).alias("fields")))
    none = F.lit(None).cast("string")
    v = lambda i, clob, text, date: F.struct(F.lit(i).alias("id"), clob.alias("clob"), text.alias("text"), date.alias("date"))
    a = v(1, F.when(k % 3 == 0, " own ").otherwise("  "), p, none)
    b = v(2, none, F.lit("c:\\fakepath\\x.pdf"), none)
    c = v(3, none, F.lit(" "), F.when(k % 3 == 0, p))
    r = v(4, F.when((k % 3 != 0) & (k % 2 == 0), "asked"), none, none)
    values = F.array(a, b, c)
    rows = table(s, d, "orders").withColumn("labels", R.field_labels(sets))
    shown = F.array_join(F.transform(R.form_fields(values, F.col("labels")), lambda f: F.concat(F.coalesce(f["label"], F.lit("-")), F.lit("="), f["value"])), "|")
    parcels = F.array(F.struct(F.lit("").alias("code"), F.lit("first").alias("owner")), F.struct(F.when(k % 4 == 0, " ").otherwise("x").alias("code"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("owner")))
    return rows.select("o_orderkey", shown.alias("fields"), R.request_text(F.array(a, b, c, r), F.col("labels")).alias("request"), R.primary_parcel(parcels)["owner"].alias("parcel"))


@plans.add("hit_cards", """
WITH t AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat FROM documents)
SELECT doc_id, sha256('### ' || (doc_id % 9 + 1) || '. ' || CASE WHEN doc_id % 3 = 0 THEN '(untitled)' ELSE source END || chr(10) || '- score: ' || (doc_id % 10) || '.2500 · ' || source || '/' || CASE WHEN doc_id % 2 = 0 THEN '—' ELSE lang END
  || chr(10) || '- document_id: `' || doc_id || '`' || chr(10) || chr(10) || substr(flat, 1, 700) || CASE WHEN length(flat) > 700 THEN chr(10) || chr(10) || '_Preview truncated._' ELSE '' END) AS card, length(flat) > 700 AS cut
FROM t""")
def hit_cards(s, d):
    i = F.col("doc_id")
    title = F.when(i % 3 == 0, " ").otherwise(F.col("source"))
    card = R.hit_card((i % 9 + 1).cast("int"), title, (i % 10 + 0.25).cast("double"), F.col("source"), F.when(i % 2 != 0, F.col("lang")), i, F.col("text"))
    return table(s, d, "documents").select("doc_id", F.sha2(card, 256).alias("card"), R.snippet(F.col("text"))["cut"].alias("cut"))


@plans.add("negative_kinds", """
WITH m AS (SELECT l_orderkey, min({'n': l_linenumber, 's': l_partkey % 2, 'd': l_suppkey % 2, 'v': l_returnflag, 'a': l_linestatus}) AS m FROM lineitem GROUP BY 1),
g AS (SELECT l_orderkey, m.s AS src, m.d AS doc, m.v AS version, m.n AS chunk, m.a AS article FROM m)
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 2 <> src OR l_suppkey % 2 <> doc THEN 'similar_law_or_case' WHEN l_returnflag = version AND l_linenumber = chunk THEN NULL
  WHEN l_returnflag <> version THEN 'current_or_repealed_version' WHEN l_linestatus <> article THEN 'neighboring_article' ELSE 'wrong_passage_same_document' END AS kind,
  CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag ELSE (l_partkey % 2) || ':' || (l_suppkey % 2) END AS family
FROM lineitem JOIN g USING (l_orderkey)""")
def negative_kinds(s, d):
    of = F.struct((F.col("l_partkey") % 2).alias("source"), (F.col("l_suppkey") % 2).alias("doc_id"), F.col("l_returnflag").alias("version"), F.col("l_linenumber").alias("chunk"), F.col("l_linestatus").alias("article"))
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", of.alias("got"))
    gold = li.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "got"))["got"].alias("gold"))
    got = F.col("got")
    family = R.family_of([F.when(F.col("l_linenumber") % 3 == 0, got["version"]), F.lit(" ")], got["source"].cast("string"), got["doc_id"])
    return li.join(gold, "l_orderkey").select("l_orderkey", "l_linenumber", R.negative_kind(got, F.col("gold")).alias("kind"), family.alias("family"))


@plans.add("state_hashes", f"""
SELECT doc_id, sha256(to_json({{'doc_id': doc_id, 'lang': CASE WHEN doc_id % 4 <> 0 THEN lang END, 'source': source}})::VARCHAR || '|{R.config_fingerprint({"size": 400, "overlap": 50})}') AS hash FROM documents""")
def state_hashes(s, d):
    docs = table(s, d, "documents").withColumn("lang", F.when(F.col("doc_id") % 4 != 0, F.col("lang")))
    return docs.select("doc_id", R.state_hash(["source", "lang", "doc_id"], R.config_fingerprint({"overlap": 50, "size": 400})).alias("hash"))


@plans.add("cacheable_results", "SELECT doc_id, doc_id % 7 IN (0, 1) AS keep FROM documents")
def cacheable_results(s, d):
    k = F.col("doc_id") % 7
    text = F.when(k == 0, F.concat(F.lit(" # "), F.col("text"))).when(k == 1, '{"hits": [{"a": 1}], "x": 2}').when(k == 2, '{"hits": []}').when(k == 3, '{"hits": [1], "degraded": true}').when(k == 4, "# Retrieval DEGRADED").when(k == 5, "> WARNING: # x").otherwise("{broken")
    return table(s, d, "documents").select("doc_id", R.cacheable(text).alias("keep"))


@plans.add("citation_safeguards", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'id_ambiguity' ELSE 'id_mismatch_deterministic' END WHEN doc_id % 5 = 0 THEN 'full_route_resolvable' ELSE 'pure_semantic' END AS safeguard FROM documents""")
def citation_safeguards(s, d):
    i = F.col("doc_id")
    cited = F.when(i % 3 == 0, F.when(i % 2 == 0, F.concat(F.lit(" "), F.col("source"))).otherwise("none"))
    carried = R.carries_id(cited, [F.lit(None), i, F.col("source")])
    return table(s, d, "documents").select("doc_id", R.safeguard_of(cited, carried, i % 5 == 0).alias("safeguard"))


@plans.add("alias_match", """
WITH a AS (SELECT p_name AS alias, min(p_partkey)::VARCHAR AS target FROM part GROUP BY 1)
SELECT l_orderkey, l_linenumber, CASE WHEN k IN (0, 1) THEN alias END AS alias, CASE WHEN k IN (0, 1) THEN target END AS target
FROM (SELECT l_orderkey, l_linenumber, l_orderkey % 4 AS k, p_name FROM lineitem JOIN part ON p_partkey = l_partkey) JOIN a ON a.alias = p_name""")
def alias_match(s, d):
    part = table(s, d, "part")
    k, n = F.col("l_orderkey") % 4, F.col("p_name")
    text = F.when(k == 0, F.concat(F.lit("„"), F.upper(n), F.lit("“"))).when(k == 1, F.concat(n, F.lit("  კანონის მუხლი 829"))).when(k == 2, F.concat(F.lit("what does a very broad question say of the "), n)).otherwise("nothing")
    q = table(s, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", text.alias("text"))
    return R.match_alias(q, part.groupBy(F.col("p_name").alias("alias")).agg(F.min("p_partkey").alias("target"))).drop("text")


@plans.add("next_windows", """
WITH o AS (SELECT o_orderkey, (o_orderkey % 40 + 1)::INT AS days, (o_custkey % 30)::INT - 2 AS total, o_orderdate::DATE AS s FROM orders)
SELECT o_orderkey, CASE WHEN total >= 20 THEN days WHEN total <= 0 THEN greatest(days + 1, days * 2) ELSE greatest(days + 1, least(days * 2, ceil(days * 25.0 / total)::INT)) END AS next_days,
  CASE WHEN days > 1 THEN s + days // 2 END AS newer_from, CASE WHEN days > 1 THEN s + days // 2 - 1 END AS older_to FROM o""")
def next_windows(s, d):
    o = table(s, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 40 + 1).cast("int").alias("days"), ((F.col("o_custkey") % 30).cast("int") - 2).alias("total"), F.col("o_orderdate").cast("date").alias("s"))
    halves = R.split_window(F.col("s"), F.date_add("s", F.col("days") - 1))
    return o.select("o_orderkey", R.adapted_days(F.col("days"), F.col("total")).alias("next_days"), halves[0]["from"].alias("newer_from"), halves[1]["to"].alias("older_to"))


@plans.add("masked_tokens", """
SELECT o_orderkey, 'On ⟦0⟧ the Civil Code, article ⟦1⟧, and ⟦2⟧ of ⟦3⟧ by ⟦4⟧.' AS masked, strftime(o_orderdate, '%Y-%m-%d') || '|' || o_custkey || '.1|№ ' || o_orderkey || '/x|"' || o_orderpriority || '"|John Smith' AS kept, true AS back FROM orders""")
def masked_tokens(s, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.concat(F.lit("On "), day, F.lit(" the Civil Code, article "), F.col("o_custkey").cast("string"), F.lit(".1, and № "), F.col("o_orderkey").cast("string"), F.lit("/x of \""), F.col("o_orderpriority"), F.lit("\" by John Smith."))
    o = table(s, d, "orders").select("o_orderkey", text.alias("t")).withColumn("m", M.masked(F.col("t")))
    return o.select("o_orderkey", F.col("m.text").alias("masked"), F.array_join("m.kept", "|").alias("kept"), M.unmasked(F.col("m.text"), F.col("m.kept")).eqNullSafe(F.col("t")).alias("back"))


PLANS = """CASE doc_id % 10 WHEN 0 THEN concat('constitutional complaint N', lpad({i}, 5, '1')) WHEN 1 THEN concat('la ley ', {i}) WHEN 2 THEN concat('AR1', lpad({i}, 6, '0')) WHEN 3 THEN concat('cases applying article ', {i}, '.2')
  WHEN 4 THEN concat('მუხლი ', {i}) WHEN 5 THEN 'what was in force' WHEN 6 THEN 'is it currently legal' WHEN 7 THEN '¿qué?' WHEN 8 THEN 'how does a court decide' ELSE concat('ბრძანება N', {i}, '/x') END"""


@plans.add("query_plans", """
SELECT doc_id, CASE k WHEN 4 THEN 'ka' WHEN 9 THEN 'ka' WHEN 1 THEN 'unsupported' WHEN 7 THEN 'unsupported' ELSE 'en' END AS language,
  CASE k WHEN 0 THEN 'case_number' WHEN 2 THEN 'citation' WHEN 3 THEN 'cases_applying' WHEN 4 THEN 'article' WHEN 5 THEN 'historical' WHEN 6 THEN CASE WHEN doc_id % 3 = 0 THEN 'historical' ELSE 'current' END WHEN 8 THEN CASE WHEN doc_id % 3 = 0 THEN 'historical' ELSE 'general' END WHEN 9 THEN 'citation' ELSE 'general' END AS intent,
  CASE k WHEN 0 THEN 'case_number' WHEN 2 THEN 'document_number' WHEN 9 THEN 'document_number' END AS kind, CASE k WHEN 0 THEN lpad(doc_id::VARCHAR, 5, '1') WHEN 2 THEN 'AR1' || lpad(doc_id::VARCHAR, 6, '0') WHEN 9 THEN doc_id || '/x' END AS value,
  CASE k WHEN 3 THEN doc_id || '.2' WHEN 4 THEN doc_id::VARCHAR END AS article, k IN (0, 3, 5, 6, 8) AS translate,
  CASE k WHEN 0 THEN lpad(doc_id::VARCHAR, 5, '1') || ',N' || lpad(doc_id::VARCHAR, 5, '1') || ',№' || lpad(doc_id::VARCHAR, 5, '1') WHEN 2 THEN 'AR1' || lpad(doc_id::VARCHAR, 6, '0') || ',NAR1' || lpad(doc_id::VARCHAR, 6, '0') || ',№AR1' || lpad(doc_id::VARCHAR, 6, '0') WHEN 9 THEN doc_id || '/x,N' || doc_id || '/x,№' || doc_id || '/x' END AS forms
FROM (SELECT doc_id, doc_id % 10 AS k FROM documents)""")
def query_plans(s, d):
    as_of = F.when(F.col("doc_id") % 3 == 0, F.lit("2020-01-01").cast("date"))
    q = table(s, d, "documents").select("doc_id", F.expr(PLANS.format(i="cast(doc_id AS string)")).alias("q")).withColumn("p", P.query_plan(F.col("q"), as_of=as_of))
    return q.select("doc_id", "p.*", F.array_join(P.citation_forms(F.col("p.value")), ",").alias("forms"))


@plans.add("declared_languages", """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ka' WHEN 1 THEN 'en' WHEN 2 THEN 'unsupported' WHEN 3 THEN 'en' ELSE 'unsupported' END AS language FROM documents""")
def declared_languages(s, d):
    k = F.col("doc_id") % 5
    declared = F.when(k == 0, " KAT ").when(k == 1, "English").when(k == 2, "fr")
    text = F.when(k == 4, "hola").otherwise(F.concat(F.lit("the "), F.col("doc_id").cast("string")))
    return table(s, d, "documents").select("doc_id", P.supported_language(text, declared).alias("language"))


@plans.add("case_folds", "SELECT doc_id, 'strasse ' || CASE doc_id % 4 WHEN 0 THEN 'οδοσ' WHEN 1 THEN 'file' WHEN 2 THEN 'i̇zmir' ELSE 'ʼnx' END AS folded, 2 AS words FROM documents")
def case_folds(s, d):
    k = F.col("doc_id") % 4
    text = F.concat(F.lit("STRAßE "), F.when(k == 0, "ΟΔΟΣ").when(k == 1, "ﬁLE").when(k == 2, "İzmir").otherwise("ŉX"))
    folded = T.casefold(text)
    return table(s, d, "documents").select("doc_id", folded.alias("folded"), F.size(F.split(folded, " ")).alias("words"))
