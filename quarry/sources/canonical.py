"""Declarative mapping of raw items of any source to one canonical document schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.parse import optional_bool, parse_date, registration_code, status_of
from quarry.functions.text import blank_to_null, content_hash, identity

#: Canonical columns and what makes each of the first raw field that is not empty.
CANONICAL = {
    "title": blank_to_null,
    "body": lambda c: F.coalesce(c, F.lit("")),
    "language": blank_to_null,
    "document_type": blank_to_null,
    "document_number": blank_to_null,
    "registration_code": registration_code,
    "status": status_of,
    "date": parse_date,
    "effective_from": parse_date,
    "effective_to": parse_date,
    "content_complete": optional_bool,
    "version_id": blank_to_null,
    "url": blank_to_null,
}


@dataclass(frozen=True)
class Spec:
    """What a source's raw keys mean: fields (canonical name -> raw keys in order), the keys of the id, constants, defaults and keys that are promoted to a map."""

    source: str
    id_fields: tuple[str, ...]
    fields: dict[str, tuple[str, ...]] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)
    complete_by_default: bool = True
    promoted: tuple[str, ...] = ()


def first_of(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """The first of the raw fields that is not empty; keys the items lack are passed over."""
    have = [blank_to_null(F.col(f"`{k}`").cast("string")) for k in keys if k in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def canonicalize(items: DataFrame, spec: Spec) -> DataFrame:
    """One canonical row an item. document_id joins the non-empty id fields by ":"; items without any have a null id and an ``issue``.

    Without an official version_id it is derived from source, id, validity and body, so the same content gives the same id.
    """
    parts = [blank_to_null(F.col(f"`{k}`").cast("string")) for k in spec.id_fields if k in items.columns]
    doc = F.nullif(F.concat_ws(":", *parts), F.lit("")) if parts else F.lit(None).cast("string")
    cols = {}
    for name, make in CANONICAL.items():
        cols[name] = F.lit(spec.constants[name]) if name in spec.constants else make(first_of(items, spec.fields.get(name, (name,))))
    cols["content_complete"] = F.coalesce(cols["content_complete"], F.lit(spec.complete_by_default))
    extra = [x for k in spec.promoted if k in items.columns for x in (F.lit(k), F.col(f"`{k}`").cast("string"))]
    promoted = F.map_filter(F.create_map(*extra), lambda k, v: v.isNotNull() & (v != "")) if extra else F.create_map().cast("map<string,string>")
    out = items.select(F.lit(spec.source).alias("source"), doc.alias("document_id"), *[c.alias(n) for n, c in cols.items()], promoted.alias("promoted"))
    derived = F.concat(F.lit("derived:"), identity(F.col("source"), F.col("document_id"), F.col("effective_from"), F.col("effective_to"), content_hash(F.col("body"))))
    out = out.withColumn("content_hash", content_hash(F.col("body"))).withColumn("version_id", F.coalesce("version_id", derived))
    return out.withColumn("issue", F.when(F.col("document_id").isNull(), "no_identity").when(~F.col("content_complete"), "incomplete_content"))


def union_sources(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
