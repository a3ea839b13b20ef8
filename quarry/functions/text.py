"""Text hygiene, folding, tokens, shingles and identity as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NEAR_EMPTY = 30  # visible characters
MOJIBAKE = 0.01  # share of U+FFFD
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x80-\x9F]"
DATA_IMAGE = r"data:image/[A-Za-z0-9.+-]+;base64,[A-Za-z0-9+/=]+"
DATA_FILE = r"data:[A-Za-z0-9.+-]+/[A-Za-z0-9.+-]+;base64,[A-Za-z0-9+/=]+"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; empty counts as missing."""
    return F.nullif(F.trim(c), F.lit(""))


#: Ranges that hold every code point, but for ß, whose full folding is not its lower case.
RARE = r"[\u00b5\u0149\u017f\u01f0\u0345\u0390\u03b0-\u03d6\u03f0-\u03f5\u0587\u13f8-\u13fd\u1c80-\u1c88\u1e96-\u1e9b\u1f50-\u1f56\u1f80-\u1ff7\uab70-\uabbf\ufb00-\ufb17]"
# Cherokee folds to its capitals.
_SMALL = "".join(map(chr, [*range(0xAB70, 0xABC0), *range(0x13F8, 0x13FE)]))
_CAPITAL = "".join(map(chr, [*range(0x13A0, 0x13F0), *range(0x13F0, 0x13F6)]))


def casefold(c: Column) -> Column:
    """Full case folding.

    Text within Latin-1 takes the short way: lower case and ß as ss. Text with a letter of ``RARE`` goes to capitals, where letters
    expand, and back; final sigma and dotless i, which that way changes, are put right.
    """
    short = F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))
    there = F.lower(F.translate(F.upper(F.translate(short, "ı", "\ue000")), "\ue000", "\ue000"))  # the optimizer drops capitals that go straight back
    full = F.translate(there, "ς\ue000" + _SMALL, "σı" + _CAPITAL)
    rare = short.rlike(r"[^\u0000-\u00b4\u00b6-\u00ff]") & short.rlike(RARE)
    return F.when(rare, full).otherwise(short)


def tokens(c: Column) -> Column:
    """Casefolded runs of letters, digits and underscore, in order, repeats kept; null text has none."""
    return F.coalesce(F.regexp_extract_all(casefold(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), F.array().cast("array<string>"))


def word_count(c: Column) -> Column:
    """White-space words; 0 for null or blank text."""
    t = F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\n\r\x0b\x0c"))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def strip_data_uris(c: Column) -> Column:
    """Embedded images become [image], other embedded files [file]."""
    return F.regexp_replace(F.regexp_replace(c, DATA_IMAGE, "[image]"), DATA_FILE, "[file]")


def strip_control(c: Column) -> Column:
    """Without C0 and C1 characters other than tab, line feed and carriage return."""
    return F.regexp_replace(c, CONTROL, "")


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode NFC, which Spark has no function for; an Arrow batch at a time."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def clean_text(c: Column) -> Column:
    """Data URIs, then control characters, then NFC."""
    return nfc(strip_control(strip_data_uris(c)))


def damage(c: Column) -> Column:
    """What is wrong with a body: counts, ratio and the first reason that applies, on the stripped text."""
    raw = F.coalesce(c, F.lit(""))
    body = strip_control(strip_data_uris(raw))
    meaningful = F.length(F.regexp_replace(body, r"\s", ""))
    bad = F.regexp_count(body, F.lit("�"))
    ratio = F.when(F.length(body) == 0, 0.0).otherwise(bad / F.length(body))
    reason = F.when(meaningful == 0, "empty_body").when(meaningful < NEAR_EMPTY, "near_empty").when(ratio >= MOJIBAKE, "mojibake")
    return F.struct(
        F.length(raw).alias("raw_length"),
        F.length(body).alias("length"),
        meaningful.alias("meaningful"),
        F.regexp_count(raw, F.lit(r"\x00")).alias("nul_chars"),
        F.regexp_count(raw, F.lit(CONTROL)).alias("control_chars"),
        bad.alias("replacement_chars"),
        F.round(ratio, 6).alias("replacement_ratio"),
        F.regexp_count(raw, F.lit(DATA_FILE)).alias("data_uris"),
        reason.alias("reason"),
    )


def content_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def shingles(c: Column, k: int = 5) -> Column:
    """Set of k-word shingles of white-space words; shorter texts are one shingle, blank texts none."""
    w = F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " ")))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < k, F.array(F.array_join(w, " "))).otherwise(many)


def plain_text_to_markdown(c: Column) -> Column:
    """LF line ends, no trailing blanks, at most one empty line, trimmed."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+\n", "\n")
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"), F.lit(" \t\n\r\x0b\x0c"))


def canonical_json(*cols: str) -> Column:
    """Key-sorted JSON of the columns; nulls are kept."""
    return F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"})


def identity(*parts: Column) -> Column:
    """SHA-256 of the parts joined by NUL; nulls are empty."""
    return F.sha2(F.concat_ws("\x00", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def uuid5(namespace_hex: str, name: Column) -> Column:
    """Version-5 UUID of a name in a namespace (32 hex digits)."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    at = lambda i, n: F.substring(h, i + 1, n)
    variant = F.lower(F.hex((F.conv(at(16, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws("-", at(0, 8), at(8, 4), F.concat(F.lit("5"), at(13, 3)), F.concat(variant, at(18, 2)), at(20, 12))
