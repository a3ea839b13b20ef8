"""Structure-aware chunks of a document as a table function.

A section is a run of lines under one heading path. Its words are numbered once; paragraphs, sentences and windows of a
long sentence are ranges of those numbers, so every budget is a subtraction and every chunk an exact slice of the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS, OVERLAP, MIN_TOKENS = 512, 80, 64
# What opens a heading, a chapter and an article.
HEADING = re.compile(r"^\s*(#{1,6})\s+(.+?)\s*#*\s*$")
CHAPTER = re.compile(r"^[ \t]*[*_]*[ \t]*((?:თავი|კარი|ნაწილი)[ \t]+[IVXLCDMა-ჰ0-9]+[^\n]*)")
ARTICLE = re.compile(r"^[ \t]*[*_]*[ \t]*(მუხლი[ \t]*(\d+)[^\n]*)")

SCHEMA = "chunk_index int, heading_path array<string>, article_id string, char_start int, char_end int, token_count int, text string, passage_hash string"


def sections(text: str) -> Iterator[tuple[list[str], str | None, int, int]]:
    """(heading path, article id, start, end) of each run of lines. Headings leave the body; chapter and article lines stay in it."""
    levels: dict[int, str] = {}
    chapter = article = article_id = None
    start = at = 0
    path: list[str] = []

    def label(m: re.Match) -> str:
        return m[1].rstrip("#*_ ").strip()

    for line in text.splitlines(keepends=True):
        here, at = at, at + len(line)
        if m := HEADING.match(line):
            yield path, article_id, start, here
            depth = len(m[1])
            levels = {k: v for k, v in levels.items() if k < depth} | {depth: m[2].strip()}
            chapter = article = article_id = None
            start = at
        elif m := CHAPTER.match(line):
            yield path, article_id, start, here
            chapter, article, article_id, start = label(m), None, None, here
        elif m := ARTICLE.match(line):
            yield path, article_id, start, here
            article, article_id, start = label(m), m[2], here
        else:
            continue
        path = [*(levels[k] for k in sorted(levels)), *([chapter] if chapter else []), *([article] if article else [])]
    yield path, article_id, start, at


def halved(text: str, start: int, end: int, cost: Callable[[str], int], budget: int) -> list[tuple[int, int]]:
    """A word as it is, or its parts after as many halvings as each needs to be within the budget."""
    if end - start < 2 or cost(text[start:end]) <= budget:
        return [(start, end)]
    middle = (start + end) // 2
    return halved(text, start, middle, cost, budget) + halved(text, middle, end, cost, budget)


def chunk_spans(text: str, start: int, end: int, cost: Callable[[str], int] | None, budget: int, overlap: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the chunks of one section; without ``cost`` each word is one token."""
    found = re.compile(r"\S+").finditer(text, start, end)
    words = [w for m in found for w in halved(text, m.start(), m.end(), cost, budget)] if cost else [m.span() for m in found]
    if not words:
        return []
    total = [0, *accumulate(max(1, cost(text[a:b])) for a, b in words)] if cost else range(len(words) + 1)
    gaps = [text[words[i][1] : words[i + 1][0]] for i in range(len(words) - 1)]
    para = [0, *(i + 1 for i, g in enumerate(gaps) if g.count("\n") > 1), len(words)]
    units: list[tuple[int, int]] = []
    for a, b in zip(para, para[1:], strict=False):
        if total[b] - total[a] <= budget:
            units.append((a, b))
            continue
        ends = [a, *(i + 1 for i in range(a, b - 1) if text[words[i][1] - 1] in ".!?…"), b]
        for s, e in zip(ends, ends[1:], strict=False):
            while total[e] - total[s] > budget:
                cut = min(e, max(s + 1, bisect_right(total, total[s] + budget) - 1))
                units.append((s, cut))
                s = cut
            if s < e:
                units.append((s, e))
    spans: list[list[int]] = []
    for s, e in units:
        if spans and total[e] - total[spans[-1][0]] <= budget:
            spans[-1][1] = e
            continue
        first = s
        if spans:  # seed with the last words that fit the overlap and leave room for the unit
            lo = spans[-1][0]
            while first > lo and total[s] - total[first - 1] <= overlap and total[e] - total[first - 1] <= budget:
                first -= 1
        spans.append([first, e])
    if len(spans) > 1 and total[spans[-1][1]] - total[spans[-1][0]] < least and total[spans[-1][1]] - total[spans[-2][0]] <= budget:
        spans[-2][1] = spans.pop()[1]
    return [(words[a][0], words[b - 1][1], total[b] - total[a]) for a, b in spans]


def chunks(text: str | None, budget: int = MAX_TOKENS, overlap: int = OVERLAP, least: int = MIN_TOKENS, cost: Callable[[str], int] | None = None) -> list[tuple]:
    """The chunks of a document in order, as rows of SCHEMA. Null and blank texts have none."""
    text, out = text or "", []
    for path, article, start, end in sections(text):
        for a, b, n in chunk_spans(text, start, end, cost, budget, overlap, least):
            piece = text[a:b]
            out.append((len(out), path, article, a, b, n, piece, hashlib.sha256(piece.encode()).hexdigest()))
    return out


def chunk_documents(docs: DataFrame, budget: int = MAX_TOKENS, overlap: int = OVERLAP, least: int = MIN_TOKENS, cost: Callable[[str], int] | None = None) -> DataFrame:
    """(doc_id, chunk...) of every document: a map over Arrow batches without a shuffle. ``cost`` counts the tokens of a word (by default one)."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["chunk_index", "heading_path", "article_id", "char_start", "char_end", "token_count", "text", "passage_hash"]
    types = [pa.int32(), pa.list_(pa.string()), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [(i, r) for i, t in enumerate(part.column(1).to_pylist()) for r in chunks(t, budget, overlap, least, cost)]
                who = part.column(0).take(pa.array([i for i, _ in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([who, *(pa.array([r[k] for _, r in rows], t) for k, t in enumerate(types))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def embed_text(text: str = "text", title: str = "title", kind: str = "kind", path: str = "heading_path"):
    """``title > type > headings`` above the text, leaving out what is missing."""
    head = F.concat_ws(" > ", F.nullif(F.col(title), F.lit("")), F.nullif(F.col(kind), F.lit("")), F.col(path))
    return F.when(head == "", F.col(text)).otherwise(F.concat(head, F.lit("\n\n"), F.col(text)))


def reassemble(chunk_rows: DataFrame) -> DataFrame:
    """(doc_id, piece_index, piece): what each chunk adds to those before it by offsets, joined by order; gaps become a blank line.

    A running maximum of the ends tells what is new, so no list of a document's chunks is gathered.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max("char_end").over(w), F.lit(0))
    r = chunk_rows.withColumn("seen", seen).where(F.col("char_end") > F.col("seen"))
    lead = F.when((F.col("seen") > 0) & (F.col("char_start") > F.col("seen")), "\n\n").otherwise("")
    new = F.expr("substring(text, greatest(seen - char_start, 0) + 1)")
    return r.select("doc_id", F.col("chunk_index").alias("piece_index"), F.concat(lead, new).alias("piece"))
