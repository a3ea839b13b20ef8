"""Reversible masking of protected tokens, for text that goes through a translator."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of identifiers, dates, numbered acts, references, quotations and names.
MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
ARTICLE_REFERENCE = r"(?:მუხლ(?:ი|ის|ში)?\s*|(?i:\barticle\s+))(?:№\s*)?\d+(?:\.\d+)*(?:\.[ა-ჿa-z])?"
NAME = r"\b[A-Z][a-z]{1,30}(?:\s+[A-Z][a-z]{1,30}){1,3}\b"
SHAPES = (
    r"\b\d{9}\.\d{2}\.\d{3}\.\d{6}\b",
    r"\b\d{18}\b",
    r"\b\d{15}\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\b\d{1,2}[./-]\d{1,2}[./-]\d{4}\b",
    rf"(?i:\b{MONTH}\s+\d{{1,2}},?\s+\d{{4}}\b)",
    rf"(?i:\b\d{{1,2}}\s+{MONTH}\s+\d{{4}}\b)",
    r"(?:№\s*|\bN(?=\d))[0-9A-Za-zა-ჿ/()\-.]+",
    r"\b[A-Z]{1,5}-?\d[0-9A-Za-z/()\-.]*\b",
    r"\b(?:[ა-ჿ]{1,3}-|\d+[ა-ჿ]*/[ა-ჿ]*-?)\d[0-9ა-ჿ/\-]*(?:\([ა-ჿ]+-?\d+\))?",
    ARTICLE_REFERENCE,
    r"[„“\"'][^„“\"'\n]{2,120}[„“\"']",
    NAME,
)
PATTERN = "|".join(SHAPES)
LEGAL_TITLE = r"\b(?:Act|Code|Constitution|Court|Law|Statute)\b"
MARK = r"⟦(\d+)⟧"


def masked(c: Column) -> Column:
    """struct(text, kept): the text with ⟦i⟧ in place of the i-th protected token, and the tokens.

    Of an article reference only the number is protected, since the word for article is translated; capitalised titles of laws and
    courts stay as text. Null text gives null.
    """
    tokens = F.regexp_extract_all(c, F.lit(f"({PATTERN})"), F.lit(1))
    gaps = F.split(c, PATTERN, -1)
    title = lambda t: t.rlike(f"^(?:{NAME})$") & t.rlike(LEGAL_TITLE)
    word = lambda t: F.when(t.rlike(f"^(?:{ARTICLE_REFERENCE})$"), F.regexp_extract(t, r"^(.*?)\d", 1)).otherwise(F.lit(""))
    parts = F.transform(tokens, lambda t: F.when(title(t), F.struct(t.alias("before"), F.lit(None).cast("string").alias("kept"))).otherwise(F.struct(word(t).alias("before"), F.substring(t, F.length(word(t)) + 1, F.length(t)).alias("kept"))))
    kept = F.transform(F.filter(parts, lambda p: p["kept"].isNotNull()), lambda p: p["kept"])
    start = F.struct(F.element_at(gaps, 1).alias("text"), F.lit(0).alias("n"))
    step = F.zip_with(parts, F.slice(gaps, F.lit(2), F.size(gaps)), lambda p, g: F.struct(p["before"].alias("before"), p["kept"].isNotNull().alias("put"), F.coalesce(g, F.lit("")).alias("gap")))
    placed = F.aggregate(step, start, lambda acc, x: F.struct(F.concat(acc["text"], x["before"], F.when(x["put"], F.concat(F.lit("⟦"), acc["n"].cast("string"), F.lit("⟧"))).otherwise(F.lit("")), x["gap"]).alias("text"), (acc["n"] + x["put"].cast("int")).alias("n")))
    return F.when(c.isNotNull(), F.struct(placed["text"].alias("text"), kept.alias("kept")))


def unmasked(text: Column, kept: Column) -> Column:
    """The tokens back in place; null if a placeholder is lost, repeated or unknown."""
    marks = F.transform(F.regexp_extract_all(text, F.lit(MARK), F.lit(1)), lambda x: x.cast("int"))
    whole = F.array_sort(marks) == F.when(F.size(kept) > 0, F.sequence(F.lit(0), F.size(kept) - 1)).otherwise(F.array().cast("array<int>"))
    gaps = F.split(text, MARK, -1)
    pieces = F.zip_with(gaps, marks, lambda g, m: F.concat(F.coalesce(g, F.lit("")), F.coalesce(F.try_element_at(kept, m + 1), F.lit(""))))
    return F.when(whole, F.array_join(pieces, ""))


def mask(text: str) -> tuple[str, list[str]]:
    """(text with ⟦i⟧ in place of each protected token, the tokens), for one text."""
    kept: list[str] = []

    def put(m: re.Match) -> str:
        token, before = m[0], ""
        if re.fullmatch(ARTICLE_REFERENCE, token):
            before = re.match(r"\D*", token)[0]
        elif re.fullmatch(NAME, token) and re.search(LEGAL_TITLE, token):
            return token
        kept.append(token[len(before) :])
        return f"{before}⟦{len(kept) - 1}⟧"

    return re.sub(PATTERN, put, text), kept


def unmask(text: str, kept: list[str]) -> str:
    """The tokens back in place; fails if a placeholder is lost, repeated or unknown."""
    found = [int(i) for i in re.findall(MARK, text)]
    if sorted(found) != list(range(len(kept))):
        raise ValueError("placeholders do not match")
    return re.sub(MARK, lambda m: kept[int(m[1])], text)
