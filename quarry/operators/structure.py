"""Positional structure of documents: markers, and what governs a span, as as-of joins on offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Article numbers (Arabic with dotted or raised suffixes, Roman) and line shapes of headings, chapters, articles, numbered clauses
# and lettered sub-clauses.
ARTICLE_ID = r"(?:\d+(?:(?:[._/-]\d+)+|[⁰¹²³⁴⁵⁶⁷⁸⁹]+)?|[IVXLCDM]+)"
SHAPES = {
    "heading": r"^[ \t]*#{1,6}[ \t]+(?P<id>[^\n]+)",
    "chapter": r"^[ \t]*(?:[#*_]+[ \t]*)?(?:თავი|კარი|ნაწილი)[ \t]+(?P<id>[IVXLCDMა-ჰ0-9]+)[^\n]*",
    "article": rf"^[ \t]*(?:[#*_]+[ \t]*)?მუხლი[ \t]*(?P<id>{ARTICLE_ID})[^\n]*",
    "clause": r"^[ \t]*(?:[*_]+[ \t]*)?(?P<id>\d+(?:\.\d+)*)[.)](?=[ \t]|$)",
    "subclause": r"^[ \t]*(?:[*_]+[ \t]*)?(?P<id>[ა-ჰ])[.)](?=[ \t]|$)",
}


def markers(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end, id, label) of every marker line, by code point offsets."""
    shapes = {k: re.compile(v, re.MULTILINE) for k, v in SHAPES.items()}
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, k, m.start(), m.end(), m["id"].strip(), m[0].strip().strip("#*_ ")) for i, t in enumerate(b.column(1)) for k, r in shapes.items() for m in r.finditer(t.as_py() or "")]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))], ["doc_id", "kind", "start", "end", "id", "label"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, kind string, start int, end int, id string, label string")


def structure_summary(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of markers, primary): article before heading before clause before flat."""
    counts = {k: F.regexp_count("text", F.lit("(?m)" + v.replace("?P<", "?<"))).alias(f"{k}s") for k, v in SHAPES.items()}
    d = docs.select("doc_id", *counts.values())
    return d.withColumn("primary", F.when(F.col("articles") > 0, "article").when(F.col("headings") > 0, "heading").when(F.col("clauses") > 0, "clause").otherwise("flat"))


def governing(spans: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, span_id, start, end) with ``id`` and ``at`` of the marker that governs each span.

    That is the last marker at or before its start, else the first within it. Two running windows over one sort of both tables by
    document and offset; no span meets all markers. Use one kind of marker at a time.
    """
    both = marks.select("doc_id", F.col("start").alias("p"), F.lit(0).alias("s"), F.struct("id", F.col("start").alias("at")).alias("m"), F.lit(None).alias("r")).unionByName(
        spans.select("doc_id", F.col("start").alias("p"), F.lit(1).alias("s"), F.lit(None).alias("m"), F.struct(*spans.columns).alias("r"))
    )
    w = Window.partitionBy("doc_id").orderBy("p", "s")
    back = F.last("m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first("m", ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    j = both.withColumn("b", back).withColumn("a", ahead).where("s = 1")
    inside = F.when(F.col("a.at") < F.col("r.end"), F.col("a"))
    return j.select("r.*", F.coalesce("b", inside).alias("g")).select(*spans.columns, "g.id", "g.at")


def context(spans: DataFrame, marks: DataFrame) -> DataFrame:
    """Article, chapter, clause and sub-clause of each span; a clause does not reach past its article, nor a sub-clause past its clause.

    One sort of spans and markers by document and offset; each kind is the last of its own before the span, else the first within it.
    """
    kinds = ("chapter", "article", "clause", "subclause")
    m = marks.where(F.col("kind").isin(*kinds))
    both = m.select("doc_id", F.col("start").alias("p"), F.lit(0).alias("s"), "kind", F.struct("id", F.col("start").alias("at")).alias("m"), F.lit(None).alias("r")).unionByName(
        spans.select("doc_id", F.col("start").alias("p"), F.lit(1).alias("s"), F.lit(None).alias("kind"), F.lit(None).alias("m"), F.struct(*spans.columns).alias("r"))
    )
    w = Window.partitionBy("doc_id").orderBy("p", "s")
    past, coming = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    own = {k: F.when(F.col("kind") == k, F.col("m")) for k in kinds}
    j = both.select("s", "r", *[F.last(c, ignorenulls=True).over(past).alias(f"{k}_b") for k, c in own.items()], *[F.first(c, ignorenulls=True).over(coming).alias(f"{k}_a") for k, c in own.items()])
    got = {k: F.coalesce(f"{k}_b", F.when(F.col(f"{k}_a")["at"] < F.col("r.end"), F.col(f"{k}_a"))) for k in kinds}
    out = j.where("s = 1").select("r.*", *[c.alias(k) for k, c in got.items()])
    floor = F.coalesce(F.col("article.at"), F.lit(-1))
    out = out.withColumn("clause", F.when(F.col("clause.at") >= floor, F.col("clause")))
    floor = F.greatest(floor, F.coalesce(F.col("clause.at"), F.lit(-1)))
    out = out.withColumn("subclause", F.when(F.col("subclause.at") >= floor, F.col("subclause")))
    out = out.select(*spans.columns, *[F.col(f"{k}.id").alias(k) for k in kinds])
    return out.withColumn("parent", F.coalesce(F.concat(F.lit("article:"), "article"), F.concat(F.lit("chapter:"), "chapter")))
