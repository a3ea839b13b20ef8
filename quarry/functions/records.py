"""Columns for records from forms, registers and search: cleaners, nested fields, ratios, timestamps, fingerprints, cards, classes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The folder that browsers put before a chosen file, and the word that ends a decision's type.
FAKE_FOLDER = r"(?i)^[a-z]:\\fakepath\\"
DECISION_WORD = "გადაწყვეტილება"
REQUEST_LABEL = "მოთხოვნის ტექსტი"
SCALE = 10_000  # basis points
SNIPPET = 700
WINDOW = 1_000  # positions of a text that are looked at together
COVERAGE = 0.6
# Words of a reference that belong to no title.
SCAFFOLD = (
    r"საქართველოს|შესახებ|კანონი[სთ]?|კოდექსი[სთ]?|მუხლი[სთ]?|ნაწილი[სთ]?|პუნქტი[სთ]?|ქვეპუნქტი[სთ]?"
    r"|მე-\d+|\d+[-–]ე|\d+(?:\.\d+)*(?:\.[ა-ჿ])?|№\s*\S+"
)


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def clean_value(c: Column) -> Column:
    """Trimmed; of a browser's file input only the file's name."""
    return strip(F.when(c.rlike(FAKE_FOLDER), F.substring_index(c, "\\", -1)).otherwise(c))


def xml_tag(c: Column, tag: str) -> Column:
    """The trimmed content of the first such element; null if there is none."""
    pattern = rf"(?s)<{tag}>(.*?)</{tag}>"
    return F.when(c.rlike(pattern), strip(F.regexp_extract(c, pattern, 1)))


def decision_type(c: Column) -> Column:
    """A title up to and with the word for decision, its white space collapsed; null without that word."""
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    at = F.instr(t, DECISION_WORD)
    return F.when(at > 0, F.substring(t, F.lit(1), at + (len(DECISION_WORD) - 1)))


def full_name(first: Column, last: Column) -> Column:
    return blank_to_null(F.concat_ws(" ", first, last))


def field_labels(sets: Column) -> Column:
    """array<struct<fields:array<struct<id, label>>>> -> map(id, label); of a repeated id the last."""
    fields = F.filter(F.flatten(F.transform(sets, lambda s: F.coalesce(s["fields"], F.array()))), lambda f: f["id"].isNotNull())
    each = F.transform(fields, lambda f: F.struct(f["id"].alias("key"), blank_to_null(f["label"]).alias("value")))
    last = F.filter(each, lambda e: F.element_at(F.filter(each, lambda o: o["key"] == e["key"]), -1).eqNullSafe(e))
    return F.map_from_entries(F.array_distinct(last))


def form_fields(values: Column, labels: Column) -> Column:
    """array<struct<id, clob, text, date>> -> array<struct<label, value>> of the first of the three that is not blank."""
    raw = lambda v: F.coalesce(*[F.when(strip(v[k]) != "", v[k]) for k in ("clob", "text", "date")])
    kept = F.filter(values, lambda v: raw(v).isNotNull())
    return F.transform(kept, lambda v: F.struct(F.try_element_at(labels, v["id"]).alias("label"), clean_value(raw(v)).alias("value")))


def request_text(values: Column, labels: Column) -> Column:
    """The clob under the request's label, else the first clob that is not blank."""
    kept = F.filter(values, lambda v: strip(v["clob"]) != "")
    asked = F.filter(kept, lambda v: F.contains(F.coalesce(F.try_element_at(labels, v["id"]), F.lit("")), F.lit(REQUEST_LABEL)))
    return strip(F.coalesce(F.try_element_at(asked, F.lit(1)), F.try_element_at(kept, F.lit(1)))["clob"])


def primary_parcel(parcels: Column) -> Column:
    """The first parcel with a code, else the first."""
    coded = F.filter(parcels, lambda p: strip(p["code"]) != "")
    return F.coalesce(F.try_element_at(coded, F.lit(1)), F.try_element_at(parcels, F.lit(1)))


def ratio(a: Column, b: Column) -> Column:
    """a / b to eight places, at most 1; null where either is null or b is 0."""
    q = F.try_divide(a, b)
    return F.round(F.when(q > 1, 1.0).otherwise(q), 8)


def meets_minimum(a: Column, b: Column, points: int) -> Column:
    """Whether a / b is at least so many basis points, in whole numbers."""
    return (b > 0) & (a.cast("bigint") * SCALE >= b.cast("bigint") * points)


def meets_maximum(a: Column, b: Column, points: int) -> Column:
    return (b > 0) & (a.cast("bigint") * SCALE <= b.cast("bigint") * points)


def utc_strict(c: Column) -> Column:
    """Timestamp (without zone) of ``YYYY-MM-DDTHH:MM:SS[.ffffff]Z``; null for any other form."""
    ok = c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$")
    return F.when(ok, F.regexp_replace(c, "Z$", "").try_cast("timestamp_ntz"))


def utc_of(c: Column) -> Column:
    """UTC timestamp (without zone) of an ISO form with ``Z`` or an offset; null where the zone is missing."""
    pattern = r"^\s*(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(?:Z|([+-])(\d{2}):(\d{2}))\s*$"
    part = lambda k: F.regexp_extract(c, pattern, k)
    number = lambda k: F.coalesce(part(k).try_cast("int"), F.lit(0))
    shift = (number(3) * 60 + number(4)) * F.when(part(2) == "-", -1).otherwise(1)
    return F.when(c.rlike(pattern), part(1).try_cast("timestamp_ntz") - F.make_dt_interval(mins=shift))


def config_fingerprint(config: dict, length: int = 16) -> str:
    """Digest of a configuration whatever the order of its keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:length]


def state_hash(columns: list[str], *fingerprints: str) -> Column:
    """Digest of a row's columns by name, and of the configurations it was made under; nulls count as nulls."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return F.sha2(F.concat_ws("|", body, *[F.lit(f) for f in fingerprints]), 256)


def snippet(c: Column, size: int = SNIPPET) -> Column:
    """struct(text, cut): white space collapsed, the first ``size`` characters, and whether that cut it."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.struct(F.substring(t, 1, size).alias("text"), (F.length(t) > size).alias("cut"))


def hit_card(rank: Column, title: Column, score: Column, source: Column, kind: Column, doc_id: Column, text: Column) -> Column:
    """A hit as a block of Markdown."""
    s = snippet(text)
    head = F.format_string("### %d. %s\n- score: %.4f · %s/%s\n- document_id: `%s`\n\n%s", rank, F.coalesce(blank_to_null(title), F.lit("(untitled)")), score, source, F.coalesce(kind, F.lit("—")), doc_id.cast("string"), s["text"])
    return F.when(s["cut"], F.concat(head, F.lit("\n\n_Preview truncated._"))).otherwise(head)


def family_of(versions: list[Column], source: Column, doc_id: Column) -> Column:
    """The first family name that is set, else source:document; null without either."""
    return F.coalesce(*[blank_to_null(v) for v in versions], F.concat(blank_to_null(source), F.lit(":"), doc_id.cast("string")))


def negative_kind(got: Column, gold: Column) -> Column:
    """Why a candidate is wrong; null for the annotated passage. Both are structs source, doc_id, version, chunk, article."""
    same = lambda k: got[k].eqNullSafe(gold[k])
    return (
        F.when(~(same("source") & same("doc_id")), "similar_law_or_case")
        .when(same("version") & same("chunk"), F.lit(None))
        .when(~same("version"), "current_or_repealed_version")
        .when(got["article"] != gold["article"], "neighboring_article")
        .otherwise("wrong_passage_same_document")
    )


def cacheable(c: Column) -> Column:
    """Whether a search response is positive and of full quality: Markdown with a heading, or JSON with hits that is not degraded."""
    t = strip(F.coalesce(c, F.lit("")))
    j = F.from_json(F.when(t.startswith("{"), t), "struct<hits:array<string>,degraded:boolean>")
    bad = (t == "") | F.lower(t).rlike("no results found|retrieval degraded") | t.startswith("> WARNING:")
    whole = (F.size(j["hits"]) > 0) & ~F.coalesce(j["degraded"], F.lit(False))
    return F.when(bad, False).when(t.startswith("{"), F.coalesce(whole, F.lit(False))).otherwise(t.startswith("# "))


def carries_id(cited: Column, payload: list[Column]) -> Column:
    """Whether a payload has the cited identifier in any of its columns."""
    wanted = strip(cited.cast("string"))
    return F.coalesce(F.array_contains(F.array(*[F.coalesce(strip(p.cast("string")), F.lit("\0")) for p in payload]), wanted), F.lit(False))


def safeguard_of(cited: Column, carried: Column, resolved: Column) -> Column:
    """What could catch a confidently wrong first result: a cited id that it has or lacks, a title that resolves, or nothing."""
    return F.when(cited.isNotNull(), F.when(carried, "id_ambiguity").otherwise("id_mismatch_deterministic")).when(resolved, "full_route_resolvable").otherwise("pure_semantic")


def normal_alias(c: Column) -> Column:
    """Lower case, without quotation marks, white space collapsed."""
    return F.trim(F.regexp_replace(F.translate(F.lower(c), "„“”«»\"'", ""), r"\s+", " "))


def match_alias(queries: DataFrame, aliases: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``queries`` with ``alias`` and ``target`` of the longest alias that the text holds (of equally long ones the first); null where it covers too little of it.

    ``aliases``: alias, target, any number of them. An alias is known by its first 2^k characters, at least half of it; the windows
    of that length at each position of the distinct texts are joined with these, and what meets is compared in full. So a text
    meets aliases that it may hold, not all of them. Scaffolding words of references count as covered. Null and empty texts hold none.
    """
    anchor = F.when(F.length("a") > 0, F.pow(F.lit(2.0), F.floor(F.log2(F.length("a").cast("double") + 0.5))).cast("int"))
    rows = aliases.select(normal_alias(F.col("alias")).alias("a"), F.col("target").cast("string").alias("t")).where("a <> ''").groupBy("a").agg(F.min("t").alias("t")).withColumn("n", anchor).withColumn("head", F.expr("substring(a, 1, n)"))
    sizes = [r[0] for r in rows.select("n").distinct().orderBy("n").collect()]  # powers of two: 31 at most
    q = normal_alias(F.col("text"))
    if not sizes:
        return queries.withColumn("alias", F.lit(None).cast("string")).withColumn("target", F.lit(None).cast("string"))
    most = rows.agg(F.max(F.length("a"))).first()[0]
    texts = queries.select(q.alias("q")).where("q <> ''").distinct().withColumn("k", F.sha2("q", 256))
    parts = texts.select("k", F.explode(F.sequence(F.lit(1), F.length("q"), F.lit(WINDOW))).alias("from"), "q").select("k", F.substring("q", F.col("from"), F.lit(WINDOW + most)).alias("part"))
    windows = F.expr(f"filter(flatten(transform(array({', '.join(map(str, sizes))}), n -> transform(sequence(1, {WINDOW}), i -> struct(i, substring(part, i, n) as head)))), x -> x.head <> '')")
    met = parts.select("k", "part", F.explode(windows).alias("x")).select("k", "x.head", F.expr(f"substring(part, x.i, {most})").alias("here"))
    held = met.join(rows.select("a", "t", "head"), "head").where(F.startswith(F.col("here"), F.col("a")))
    best = held.groupBy("k").agg(F.min_by(F.struct("a", "t"), F.struct(-F.length("a"), "a")).alias("__best")).withColumnRenamed("k", "__k")
    out = queries.join(best, F.sha2(q, 256) == F.col("__k"), "left").drop("__k")
    a = F.col("__best.a")
    rest = F.replace(q, a, F.lit(""))
    scaffold = F.aggregate(F.regexp_extract_all(rest, F.lit(f"({SCAFFOLD})"), F.lit(1)), F.lit(0), lambda n, x: n + F.length(x))
    enough = (F.length(a) + scaffold) / F.greatest(F.length(q), F.lit(1)) >= coverage
    return out.withColumn("alias", F.when(enough, a)).withColumn("target", F.when(enough, F.col("__best.t"))).drop("__best")


def adapted_days(days: Column, total: Column, target: int = 20, most: int = 366) -> Column:
    """Length of the next older window: the same where enough came back, else more, by what 25 would need, twice at most."""
    estimate = F.ceil(days * 25 / total).cast("int")
    grown = F.greatest(days + 1, F.least(days * 2, estimate))
    return F.when(total >= target, days).when(total <= 0, F.least(F.lit(most), F.greatest(days + 1, days * 2))).otherwise(F.least(F.lit(most), grown))


def split_window(start: Column, end: Column) -> Column:
    """array of the newer and the older half, struct(from, to); a window of one day cannot be split and gives null."""
    days = F.datediff(end, start) + 1
    middle = F.date_add(start, F.floor(days / 2).cast("int"))
    halves = F.array(F.struct(middle.alias("from"), end.alias("to")), F.struct(start.alias("from"), F.date_sub(middle, 1).alias("to")))
    return F.when(days > 1, halves)
