"""HTML to Markdown by the standard parser, as an Arrow function."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Elements that are dropped with their content, and those that end a block.
DROPPED = {"script", "style", "noscript", "form", "textarea", "button", "head"}
DROPPED_CLASSES = {"btn-group", "annotator-adder", "document-anchor-panel", "hide"}
BODY = {"body", "main", "article", "section", "div", "p", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "span", "a", "br", "img"}  # what ends a head that is left open
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "ul", "ol", "blockquote", "pre", "figure", "address", "dl", "dd", "dt"}
SUPER = str.maketrans("0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ")
SUB = str.maketrans("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")


# The parts of a table's id that give a section its depth.
STRUCTURAL = ("HEADER", "PREAMBLE", "ARTICLE", "FOOTER", "ENCLOSURE", "CHAPTER", "SECTION", "PART", "BOOK", "TITLE", "SUBSECTION", "PARAGRAPH")
LEVEL = re.compile(rf"(?<![^;])(?:{'|'.join(STRUCTURAL)})(?::\d+)?(?=[;_])")
#: What a table stands for, by the first pattern that its id fits: None is text, a pair is a heading (added to the number of
#: structural parts, least level), of six at most.
ONLY_HEADER = r"(?:DOCUMENT(?::\d+)?;|;)*HEADER(?::\d+)?;*"
SECTIONS = [
    (re.compile(ONLY_HEADER + "_Content"), (0, 1)),  # the document's title
    (re.compile(ONLY_HEADER + "_Title"), None),
    (re.compile(r".*_Content", re.S), None),
    (re.compile(r"(?:.*;)?HEADER(?::\d+)?;*_Title", re.S), (0, 1)),  # a section's own header
    (re.compile(r".*_Title", re.S), (1, 2)),
]


def section_of(table_id: str) -> tuple[str, int] | None:
    """("heading", level) or ("block", 0) of a table that wraps a section, by its id; null for any other table."""
    for pattern, rule in SECTIONS:
        if pattern.fullmatch(table_id):
            return ("heading", min(6, max(rule[1], rule[0] + len(LEVEL.findall(table_id))))) if rule else ("block", 0)
    return None


class _Markdown(HTMLParser):
    """Writes Markdown as elements come. ``skip`` is the stack of open elements from a dropped one on; what ends a head that was not closed ends it."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.out, self.skip, self.lists, self.links, self.tables, self.script = base, [], [], [], [], [], None

    def put(self, s: str) -> None:
        for t in reversed(self.tables):
            if t.get("wrap") != "block":
                if t["cell"] is not None:
                    t["cell"].append(s)
                    return
                break
        self.out.append(s)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.skip == ["head"] and tag in BODY:
            self.skip = []
        if tag in DROPPED or self.skip or not DROPPED_CLASSES.isdisjoint((a.get("class") or "").split()):
            if tag not in VOID:
                self.skip.append(tag)
            return
        if tag[0] == "h" and tag[1:].isdigit():
            self.put("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.put("\n")
        elif tag in BLOCKS:
            self.put("\n\n")
        elif tag == "br":
            self.put("\n")
        elif tag == "hr":
            self.put("\n\n---\n\n")
        elif tag == "li":
            top = self.lists[-1] if self.lists else ["ul", 0]
            top[1] += 1
            self.put("\n" + "  " * max(0, len(self.lists) - 1) + (f"{top[1]}. " if top[0] == "ol" else "- "))
        elif tag in ("b", "strong"):
            self.put("**")
        elif tag in ("i", "em"):
            self.put("*")
        elif tag in ("sup", "sub"):
            self.script = tag
        elif tag == "a":
            href = a.get("href") or ""
            self.links.append("" if not href or href.startswith(("#", "javascript:")) else urljoin(self.base, href))
            self.put("[" if self.links[-1] else "")
        elif tag == "img" and a.get("src"):
            self.put(f"![{a.get('alt') or ''}]({urljoin(self.base, a['src'])})")
        elif tag == "table" and (wrap := section_of(a.get("id") or "")):
            self.put("\n\n")
            self.tables.append({"wrap": wrap[0], "level": wrap[1], "cell": [] if wrap[0] == "heading" else None})
        elif tag == "table":
            self.tables.append({"rows": [], "cell": None, "down": {}})
        elif self.tables and self.tables[-1].get("wrap"):
            return
        elif tag == "tr" and self.tables:
            self.tables[-1]["rows"].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]["rows"]:
            t = self.tables[-1]
            span = lambda k: max(1, min(int(a[k]), 100)) if (a.get(k) or "").isdigit() else 1
            t["cell"], t["span"] = [], (span("colspan"), span("rowspan"))

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:  # whatever was left open inside ends with it
                del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag) :]
            return
        if tag in ("b", "strong"):
            self.put("**")
        elif tag in ("i", "em"):
            self.put("*")
        elif tag in ("sup", "sub"):
            self.script = None
        elif tag == "a" and self.links:
            href = self.links.pop()
            self.put(f"]({href})" if href else "")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.put("\n\n")
        elif tag in BLOCKS or (tag[0] == "h" and tag[1:].isdigit()):
            self.put("\n\n")
        elif tag == "table" and self.tables and self.tables[-1].get("wrap"):
            t = self.tables.pop()
            if t["wrap"] == "heading" and (text := re.sub(r"[\s#*]+", " ", "".join(t["cell"])).strip()):
                self.put("#" * t["level"] + " " + text)
            self.put("\n\n")
        elif tag in ("td", "th", "tr") and self.tables and self.tables[-1].get("wrap"):
            return
        elif tag in ("td", "th") and self.tables and self.tables[-1]["cell"] is not None:
            t = self.tables[-1]
            text, t["cell"] = re.sub(r"\s+", " ", "".join(t["cell"])).strip().replace("|", "\\|"), None
            row, y = t["rows"][-1], len(t["rows"]) - 1
            while (y, len(row)) in t["down"]:
                row.append(t["down"][y, len(row)])
            for x in range(t["span"][0]):
                for dy in range(1, t["span"][1]):
                    t["down"][y + dy, len(row)] = text
                row.append(text)
        elif tag == "table" and self.tables:
            t = self.tables.pop()
            for y, row in enumerate(t["rows"]):
                while (y, len(row)) in t["down"]:
                    row.append(t["down"][y, len(row)])
            rows = [r for r in t["rows"] if any(r)]
            width = max((len(r) for r in rows), default=0)
            if width < 2:  # a layout table: its cells are paragraphs
                self.put("\n\n" + "\n\n".join(c for r in rows for c in r if c) + "\n\n")
            else:
                lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
                self.put("\n\n" + "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]) + "\n\n")

    def handle_data(self, data):
        if not self.skip:
            s = re.sub(r"[ \t\r\f\n]+", " ", data)
            self.put(s.translate(SUPER if self.script == "sup" else SUB) if self.script else s)


def parsed(html: str | None, base: str = "") -> tuple[str, str | None]:
    """(Markdown of a page, what went wrong): null and empty pages give "", a page that breaks the parser gives "" and the fault."""
    try:
        p = _Markdown(base or "")
        p.feed(html or "")
        p.close()
        t = "".join(p.out)
    except (AssertionError, IndexError, KeyError, TypeError, ValueError) as e:  # what damaged markup can raise
        return "", f"{type(e).__name__}: {e}"
    t = re.sub(r"\*\*\s*\*\*", "", t)
    t = re.sub(r"[ \t]*\n[ \t]*(?=\n|\S)", "\n", re.sub(r"[ \t]{2,}", " ", t)) if "\n  " not in t else re.sub(r"[ \t]+\n", "\n", t)
    return re.sub(r"\n{3,}", "\n\n", t).strip(), None


def html_to_markdown(html: str | None, base: str = "") -> str:
    """Markdown of a page; "" for null or what cannot be parsed. Relative links take ``base``."""
    return parsed(html, base)[0]


@F.pandas_udf(StringType())
def markdown_of(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([html_to_markdown(h, b) for h, b in zip(html, base, strict=True)], dtype=object)


@F.pandas_udf(StructType([StructField("markdown", StringType()), StructField("fault", StringType())]))
def page_of(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    """Markdown and, where the page could not be parsed, the fault."""
    return pd.DataFrame([parsed(h, b) for h, b in zip(html, base, strict=True)], columns=["markdown", "fault"], dtype=object)
