"""Dates, identifiers, languages and query plans as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Georgian month stems, act and case words, and the shapes of identifiers.
MONTHS = {"იანვ": "01", "თებ": "02", "მარტ": "03", "აპრ": "04", "მაი": "05", "ივნ": "06", "ივლ": "07", "აგვ": "08", "სექ": "09", "ოქტ": "10", "ნოე": "11", "დეკ": "12"}
REGISTRATION_LONG = r"(?U)\b\d{9}\.\d{2}\.\d{3}\.\d{6}\b"
NUMBER_18 = r"(?U)\b\d{18}\b"
REGISTRATION_15 = r"(?U)\b\d{15}\b"
LETTERED = r"\b[A-Z]{2}\d{5,}\b"
ACT_NUMBER = r"(?:№\s*|\bN(?=[0-9]))([0-9][0-9A-Za-zა-ჿ/()\-]*)"
ACT_WORDS = r"ბრძანებ|დადგენილებ|კანონ|განკარგულებ|წესდებ|რეზოლუცი"
CASE_NUMBER = r"(?U)\b(?:(?!მე-)[ა-ჿ]{1,3}-|\d+[ა-ჿ]*/[ა-ჿ]*-?)[0-9][0-9ა-ჿ/\-]*(?:\([ა-ჿ]+-?\d+\))?"
CASE_WORDS = r"საქმ|განჩინებ|განაჩენ|გადაწყვეტილებ|სარჩელ"
LATIN_CASE = r"(?i)\b[A-Z]{1,3}-\d{1,7}/\d{2,4}\b"
LATIN_CASE_WORDS = r"(?i)\b(?:case|judg(?:e)?ment|decision|ruling)\b"
COURT_NUMBER = r"(?:№\s*|\bN(?=\d))(\d{2,6})\b"
COURT_WORDS = r"(?i)კონსტიტუციურ[^\n]{0,40}(?:სარჩელ|წარდგინებ)|(?:constitutional\s+(?:claim|complaint|submission))"
ARTICLE_AFTER = r"\s*[-–]?ე?\s*მუხლ"
ARTICLE = r"(?i)(?:მუხლ(?:ი|ის|ში)?\s*(?:№\s*)?|\barticle\s*(?:no\.?\s*|§\s*)?)(\d+(?:\.\d+)*(?:\.[ა-ჿa-z])?)"
CASES_APPLYING = r"(?i)(?:საქმე(?:ები|ებს)?[^\n]{0,80}(?:გამოიყენ|შეეხ|განმარტ)|(?:cases?|decisions?)\s+(?:applying|interpreting|under|about))"
OLD = r"(?i)(?:იმ\s+დროისთვის|ისტორიულ|ყოფილ\s+რედაქცი|ძალაში\s+იყო|historical|formerly|at\s+the\s+time|was\s+in\s+force|as\s+of\s+\d{4})"
NOW = r"(?i)(?:ამჟამად|დღეს|მოქმედი\s+(?:კანონ|რედაქცი)|ძალაშია|current(?:ly)?|in[- ]force|law\s+now|as\s+of\s+today)"
ENGLISH_TERMS = (
    "a an and application are article case cases civil code complaint constitution contract court current damages decision decree does "
    "effective for from how in is law legal may of number on order permit registry right rule statute the this to under version was what "
    "when which who with"
)


def parse_date(c: Column) -> Column:
    """ISO, day-first numeric or Georgian text dates as DATE. The first shape that matches decides, even if it is no real date."""
    v = F.trim(c)
    iso, dmy = r"(\d{4})-(\d{2})-(\d{2})", r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
    geo = r"(\d{1,2})\s+([ა-ჿ]+)\s*,?\s*(\d{4})"
    part = lambda p, i: F.regexp_extract(v, p, i)
    real = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    word = part(geo, 2)
    month = F.lit(None).cast("string")
    for stem, mm in MONTHS.items():
        month = F.when(word.startswith(stem), mm).otherwise(month)
    return F.when(v.rlike(iso), real(part(iso, 1), part(iso, 2), part(iso, 3))).when(v.rlike(dmy), real(part(dmy, 3), part(dmy, 2), part(dmy, 1))).when(v.rlike(geo) & month.isNotNull(), real(part(geo, 3), month, part(geo, 1)))


def parse_day_first(c: Column) -> Column:
    """DD-MM-YYYY, DD/MM/YYYY or DD.MM.YYYY as DATE."""
    v = F.trim(c)
    return F.coalesce(*[F.when(v.rlike(rf"^\d{{1,2}}{s}\d{{1,2}}{s}\d{{4}}$"), F.try_to_date(v, f"d{p}M{p}yyyy")) for s, p in (("-", "-"), ("/", "/"), (r"\.", "."))])


def dotnet_date(c: Column) -> Column:
    """/Date(milliseconds)/ as the UTC calendar date."""
    ms = F.regexp_extract(c, r"/Date\((-?\d+)(?:[+-]\d+)?\)/", 1)
    return F.when(ms != "", F.to_date(F.to_utc_timestamp(F.timestamp_millis(ms.try_cast("bigint")), F.current_timezone())))


def date_prefix(c: Column) -> Column:
    """The leading YYYY-MM-DD of a text, else the trimmed text."""
    d = F.regexp_extract(c, r"^\s*(\d{4}-\d{2}-\d{2})", 1)
    return F.when(d != "", d).otherwise(F.trim(c))


def local_date(ts: Column, zone: str = "+04:00") -> Column:
    """The calendar date of a UTC instant in a zone."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def optional_bool(c: Column) -> Column:
    """1 / true / yes and 0 / false / no, whatever the case; anything else is null."""
    v = F.lower(F.trim(c.cast("string")))
    return F.when(v.isin("1", "true", "yes"), True).when(v.isin("0", "false", "no"), False)


def ordered_distinct(c: Column) -> Column:
    """Trimmed non-empty elements, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def registration_code(c: Column) -> Column:
    """The trimmed code; placeholders, punctuation and zeros alone are null."""
    v = F.trim(c)
    return F.when(v.rlike(r"[1-9\p{L}]") & ~F.lower(v).isin("n/a", "none", "null", "-"), v)


def status_of(c: Column) -> Column:
    """in_force, repealed or pending by the words it has; null if none."""
    v = F.lower(c)
    return F.when(v.contains("repeal") | v.contains("ძალადაკარგულ"), "repealed").when(v.contains("pending") | v.contains("ასამოქმედებელ"), "pending").when(v.contains("force") | v.contains("მოქმედ"), "in_force")


def status_by_dates(start: Column, end: Column, as_of: Column) -> Column:
    return F.when(start > as_of, "pending").when(end <= as_of, "repealed").when(start.isNotNull(), "in_force")


def language_of(c: Column) -> Column:
    """ka if there is any Georgian letter, else en."""
    return F.when(c.rlike(r"[ა-ჿ]"), "ka").otherwise("en")


def supported_language(c: Column, declared: Column | None = None) -> Column:
    """ka, en or unsupported: what is declared, else by letters and, for plain Latin text, by common English words.

    Text without letters is English if it has a digit, since an identifier needs no language.
    """
    v = F.trim(F.coalesce(c, F.lit("")))
    words = F.regexp_extract_all(F.lower(v), F.lit("[a-z]+"), F.lit(0))
    known = F.array(*[F.lit(w) for w in ENGLISH_TERMS.split()])
    plain = F.when(v.rlike("[A-Za-z]"), F.arrays_overlap(words, known)).otherwise(v.rlike(r"\d"))
    found = F.when(v.rlike(r"[ა-ჿ]"), "ka").when(v.rlike(r"[^\x00-\x7f]"), "unsupported").when(plain, "en").otherwise("unsupported")
    if declared is None:
        return found
    d = F.lower(F.trim(declared))
    return F.when(d.isNull(), found).when(d.isin("ka", "geo", "kat", "georgian"), "ka").when(d.isin("en", "eng", "english"), "en").otherwise("unsupported")


def citation(c: Column) -> Column:
    """struct(kind, value) of the first identifier shape that the text has, else null; article references are none."""
    q = F.coalesce(c, F.lit(""))

    def found(kind: str, pattern: str, group: int = 0, gate: Column | None = None) -> Column:
        v = F.regexp_extract(q, pattern, group)
        ok = v != ""
        return F.when(ok & gate if gate is not None else ok, F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    # the guards are part of the gate: the number is followed by the word for article
    article = lambda p: ~q.rlike(f"(?:{p}){ARTICLE_AFTER}")
    return F.coalesce(
        found("registration_code", REGISTRATION_LONG),
        found("document_number", NUMBER_18),
        found("registration_code", REGISTRATION_15),
        found("document_number", LETTERED),
        found("case_number", COURT_NUMBER, 1, q.rlike(COURT_WORDS)),
        found("document_number", ACT_NUMBER, 1, q.rlike(ACT_WORDS) & article(ACT_NUMBER)),
        found("case_number", CASE_NUMBER, 0, q.rlike(CASE_WORDS) & article(CASE_NUMBER)),
        found("case_number", LATIN_CASE, 0, q.rlike(LATIN_CASE_WORDS)),
    )


def citation_forms(value: Column) -> Column:
    """The forms under which a cited number may be stored: as it is, and with either prefix where it has none."""
    forms = F.array(value, F.concat(F.lit("N"), value), F.concat(F.lit("№"), value))
    return F.when(value.rlike("^[N№]"), F.array(value)).when(value.isNotNull(), forms)


def article_references(c: Column, limit: int = 4, own: Column | None = None) -> Column:
    """Distinct article numbers in text order, without the text's ``own``."""
    all_ = F.array_distinct(F.regexp_extract_all(c, F.lit(ARTICLE), F.lit(1)))
    return F.slice(all_ if own is None else F.filter(all_, lambda x: ~x.eqNullSafe(own)), 1, limit)


def intent_of(c: Column, as_of: Column | None = None) -> Column:
    """Of a question: cases_applying, case_number, article, citation, historical (also where a date is asked for), current or general, the first that applies."""
    k = citation(c)
    past = c.rlike(OLD) if as_of is None else c.rlike(OLD) | as_of.isNotNull()
    return (
        F.when(c.rlike(CASES_APPLYING), "cases_applying").when(k["kind"] == "case_number", "case_number").when(c.rlike(ARTICLE), "article")
        .when(k.isNotNull(), "citation").when(past, "historical").when(c.rlike(NOW), "current").otherwise("general")
    )


def query_plan(c: Column, declared: Column | None = None, as_of: Column | None = None) -> Column:
    """struct(language, intent, kind, value, article, translate): how a question is to be retrieved.

    A question that is an identifier alone needs no language. In an unsupported language the intent is general and nothing is translated.
    English text that is more than an identifier is translated.
    """
    k = citation(c)
    rest = F.replace(c, F.coalesce(k["value"], F.lit("\0")), F.lit(""))
    bare = k.isNotNull() & ~rest.rlike("[A-Za-zა-ჿ]")
    lang = supported_language(c, declared)
    if declared is None:
        lang = F.when(bare & (lang == "unsupported"), "en").otherwise(lang)
    ok = lang != "unsupported"
    article = F.nullif(F.regexp_extract(c, ARTICLE, 1), F.lit(""))
    return F.struct(
        lang.alias("language"), F.when(ok, intent_of(c, as_of)).otherwise("general").alias("intent"), k["kind"].alias("kind"), k["value"].alias("value"), article.alias("article"),
        ((lang == "en") & ~bare & c.rlike("[A-Za-z]")).alias("translate"),
    )


def date_windows(start: Column, end: Column, unit: str = "month") -> Column:
    """Gap-free calendar windows that cover [start, end], the outer ends clamped: array of struct(from, to)."""
    step = F.expr(f"interval 1 {unit}")
    first = F.trunc(start, unit)
    return F.transform(F.sequence(first, end, step), lambda d: F.struct(F.greatest(d, start).alias("from"), F.least(F.date_sub((d + step).cast("date"), 1), end).alias("to")))


def page_count(total: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / size))


def double_json(c: Column, schema: str) -> Column:
    """JSON that may be encoded twice."""
    return F.coalesce(F.from_json(F.when(F.trim(c).startswith('"'), F.from_json(F.concat(F.lit('{"x":'), c, F.lit("}")), "struct<x:string>")["x"]).otherwise(c), schema), F.lit(None))


def evidence_id(*parts: Column) -> Column:
    """A reversible locator: base64 of the JSON of its parts with a short digest."""
    body = F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)]))
    return F.base64(F.encode(F.concat(F.substring(F.sha2(body, 256), 1, 16), body), "UTF-8"))


def read_evidence_id(c: Column, n: int) -> Column:
    """The parts of a locator, null if its digest does not fit."""
    raw = F.decode(F.unbase64(c), "UTF-8")
    body = F.substring(raw, 17, 1_000_000)
    return F.when(F.substring(F.sha2(body, 256), 1, 16) == F.substring(raw, 1, 16), F.from_json(body, "struct<" + ",".join(f"p{i}:string" for i in range(n)) + ">"))
