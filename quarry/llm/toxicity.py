"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

SAMPLE_ROWS = 20_000  # labelled rows a lexicon is learned from, at most
SAMPLE_FILES = 48
SHORTEST = 3  # letters of the shortest term
WEIGHT = 2.0  # least log-odds of a term
SPARED = 3  # clean documents that have an exception phrase, at least
THRESHOLD = 0.3
TERMS_HELD = 60_000  # terms a counting worker gathers before it passes them on; a memory bound only

# Letters of other scripts that look like Latin ones, and digits and signs read as letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ß": "ss",
    "0": "o", "1": "i", "l": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
}


def _fold_table() -> dict[int, str | None]:
    """Letters with marks and compatibility forms (full-width, mathematical, circled, raised) fold by their decomposition; format
    characters vanish. ``i``, ``l`` and ``1`` are one letter."""
    table: dict[int, str | None] = {}
    for c in [*range(0xC0, 0x250), *range(0x1D00, 0x1F00), *range(0x2070, 0x20A0), *range(0x2100, 0x2190), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x1F110, 0x1F16A)]:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(c).lower()) if not unicodedata.combining(x)).lower()
        plain = "".join(x for x in plain if x not in "()")
        if plain != chr(c):
            table[c] = "".join(LOOKALIKES.get(x, x) for x in plain)
    for a, b in LOOKALIKES.items():
        table[ord(a)] = LOOKALIKES.get(b, b)
    for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)):
        table[c] = None
    return table


FOLD = _fold_table()
_GAP = re.compile(r"[\W_]+")
_BARS = re.compile(r"(?<=\w)[|!](?=\w)")


def fold(text: str) -> str:
    """Lower case, look-alikes and digits to Latin letters, everything between words to one space, one space at each end."""
    text = text.lower()
    if "|" in text or "!" in text:
        text = _BARS.sub("i", text)
    return f" {_GAP.sub(' ', text.translate(FOLD)).strip()} "


def beginnings(n: int) -> list[int]:
    """Lengths, under n, of the beginnings of an n-letter word that may become terms: each up to 16, then every fourth part longer."""
    out, k = [], SHORTEST
    while k < n:
        out.append(k)
        k = k + 1 if k < 16 else k * 5 // 4
    return out


def terms_of(text: str) -> Counter:
    """How often each beginning of a word that may become a term occurs; a whole word ends in a space."""
    out: Counter = Counter()
    for w, k in Counter(fold(text).split()).items():
        if len(w) >= SHORTEST:
            for n in beginnings(len(w)):
                out[w[:n]] += k
            out[w + " "] += k
            out[w] += k
    return out


@dataclass
class Lexicon:
    """Terms (word beginnings; with a final space: whole words) and weights, and the fitted score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    coef: tuple[float, float, float] = (-4.0, 2.0, 1.0)
    _auto: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_auto"} | {"_auto": None}

    def _automaton(self):
        if self._auto is None:
            a = ahocorasick.Automaton()
            for t, w in self.weights.items():
                t = fold(t).rstrip() + " " * t.endswith(" ")
                a.add_word(t, (len(t), w))
            for e in self.exceptions:
                e = fold(e)
                a.add_word(e, (len(e), None))
            a.make_automaton()
            self._auto = a
        return self._auto

    def weight(self, text: str) -> tuple[float, int]:
        """(sum over words of their heaviest term, words). Terms within an exception phrase count nothing."""
        folded = fold(text)
        words = folded.count(" ") - 1 if len(folded) > 2 else 0
        if not self.weights or not words:
            return 0.0, words
        best, spared = self._found(folded)
        return sum(w for at, w in best.items() if not spared(at)), words

    def _found(self, folded: str):
        """({start of a word: its heaviest term's weight}, whether a start lies within an exception phrase)."""
        best: dict[int, float] = {}
        spans: list[list[int]] = []
        for end, (n, w) in self._automaton().iter(folded):
            at = end - n + 1
            if w is not None:
                if w > best.get(at, 0.0):
                    best[at] = w
            else:  # ends ascend, so what overlaps is at the end of the list
                while spans and spans[-1][1] >= at:
                    at = min(at, spans.pop()[0])
                spans.append([at, end])
        starts = [a for a, _ in spans]

        def spared(at: int) -> bool:
            k = bisect_right(starts, at) - 1
            return k >= 0 and at < spans[k][1]

        return best, spared

    def phrases(self, text: str) -> set[str]:
        """The pairs of neighbouring words, one of them matched, that might be exceptions."""
        folded = fold(text)
        best, out = self._found(folded)[0], set()
        for at in best:
            end = folded.index(" ", at + 1)
            if end < len(folded) - 1:
                out.add(folded[at + 1 : folded.index(" ", end + 1)])
            if at:
                out.add(folded[folded.rindex(" ", 0, at) + 1 : end])
        return out

    def score(self, total: float, words: int) -> float:
        x = self.coef[0] + self.coef[1] * math.log1p(total) + self.coef[2] * math.log1p(100 * total / (words + 20))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def choose_terms(counts: list[tuple[str, int, int, int]], toxic: int, clean: int, least: int = 3) -> dict[str, float]:
    """Weights from (term, toxic documents, occurrences in toxic, in clean documents), by smoothed log-odds of occurrence.

    A longer beginning is kept only if it says clearly more than the shorter ones that are.
    """
    weights: dict[str, float] = {}
    for t, docs, a, b in sorted(counts, key=lambda x: (len(x[0]), x[0])):
        if docs < least:
            continue
        w = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) - 1.0 / math.sqrt(docs)
        shorter = max((weights.get(t[:n], 0.0) for n in beginnings(len(t))), default=0.0)
        if w >= WEIGHT and w > shorter + 0.7:
            weights[t] = w
    return weights


def fit_score(rows: list[tuple[float, int, int]], ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression of the label on log weight and log density, by Newton steps with a small ridge."""
    if not rows:
        return Lexicon({}).coef
    x = np.array([(1.0, math.log1p(s), math.log1p(100 * s / (n + 20))) for s, n, _ in rows])
    y = np.array([r[2] for r in rows], dtype=float)
    b = np.zeros(3)
    pen = np.diag([1e-3, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pen, x.T @ (y - p) - pen @ b)
        b += step
        if abs(step).max() < 1e-8:
            break
    return tuple(map(float, b))


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "toxic") -> Lexicon:
    """Learn terms, weights and the score from labelled documents.

    ``labels`` (doc_id and the label column) holds only rows that may be learned from; labels other than 0 and 1, null ids and null
    texts are ignored, repeated labels of a document count once (the greater). At most about ``sample_rows`` rows, the
    first by a hash of doc_id, are used, each with its whole text. Terms are counted on the executors; those that are at least half
    as telling as ``WEIGHT`` asks reach the driver, so their number is bounded by the sample. Exception phrases are learned
    too: pairs of words, one of them matched, that ``SPARED`` clean documents or more have and toxic ones have no
    oftener. The score is fitted to totals from a lexicon of the other half, so that it does not trust chance terms.
    Without labelled rows of both kinds the lexicon is empty.
    """
    own = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
    n = own.count()
    if n > sample_rows:
        own = own.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
    own = own.withColumn("__half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")).withColumnRenamed("doc_id", "__id")
    sample = docs.select("doc_id", "text").join(F.broadcast(own), F.col("doc_id") == F.col("__id")).where("text is not null").select("text", "__y", "__half")
    sample = materialize(sample.repartition(SAMPLE_FILES), "labelled")  # the corpus is read once for it

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()  # occurrences, and documents above bit 40

        def flushed() -> pa.RecordBatch:
            keys, values = list(held), list(held.values())
            held.clear()
            cols = [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array([v >> 40 for v in values], pa.int64()), pa.array([v & (1 << 40) - 1 for v in values], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, ["term", "kind", "d", "n"])

        for b in batches:
            for t, y, h in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                kind = 2 * h + y
                for x, k in terms_of(t.as_py()).items():
                    held[x, kind] += k + (1 << 40)
                held["", kind] += 1 + (1 << 40)
                if len(held) > TERMS_HELD:
                    yield flushed()
        if held:
            yield flushed()

    def of(k: int, what: str) -> Column:
        return F.sum(F.when(F.col("kind") == k, F.col(what)).otherwise(0))

    sums = [of(k, w).alias(f"{w}{k}") for w in "dn" for k in range(4)]
    counts = sample.mapInArrow(count, "term string, kind int, d long, n long").groupBy("term").agg(*sums)
    counts = materialize(counts, "terms")
    all_ = counts.where("term = ''").first()
    if not all_ or not (all_.d1 + all_.d3) or not (all_.d0 + all_.d2):
        return Lexicon({}, coef=(-4.0, 0.0, 0.0))
    a, b = (F.col("n1") + F.col("n3") + 0.5) / (all_.d1 + all_.d3 + 1), (F.col("n0") + F.col("n2") + 0.5) / (all_.d0 + all_.d2 + 1)
    rows = counts.where((F.col("term") != "") & (F.col("d1") + F.col("d3") >= 2) & (F.log(a / b) >= WEIGHT / 2)).orderBy("term").collect()
    halves = [Lexicon(choose_terms([(r.term, r[f"d{y}"], r[f"n{y}"], r[f"n{y - 1}"]) for r in rows], all_[f"d{y}"], all_[f"d{y - 1}"], 2)) for y in (1, 3)]

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [halves[1 - h].weight(t.as_py()) for t, h in zip(b.column(0), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), b.column(1)], ["s", "n", "y"])

    fitted = [tuple(r) for r in sample.mapInArrow(totals, "s double, n long, y int").collect()]  # at most sample_rows
    weights = choose_terms([(r.term, r.d1 + r.d3, r.n1 + r.n3, r.n0 + r.n2) for r in rows], all_.d1 + all_.d3, all_.d0 + all_.d2)
    return Lexicon(weights, learn_exceptions(sample, Lexicon(weights), all_.d1 + all_.d3, all_.d0 + all_.d2), fit_score(sorted(fitted)))


def learn_exceptions(sample: DataFrame, lexicon: Lexicon, toxic: int, clean: int) -> tuple[str, ...]:
    """Phrases around matched words that clean documents of ``sample`` (text, __y) have and toxic ones have no oftener."""
    if not lexicon.weights:
        return ()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = Counter((p, y) for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True) for p in lexicon.phrases(t.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int32()), pa.array(list(held.values()), pa.int64())], ["p", "y", "n"])

    found = sample.select("text", "__y").mapInArrow(count, "p string, y int, n long").groupBy("p").pivot("y", [0, 1]).agg(F.sum("n")).fillna(0, ["0", "1"])
    fits = (F.col("0") >= SPARED) & ((F.col("1") + 0.5) / (toxic + 1) <= (F.col("0") + 0.5) / (clean + 1))
    return tuple(r.p for r in found.where(fits).select("p").orderBy("p").collect())  # bounded by the sample


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``score`` (0 to 1). Only the text is read; null or empty text scores as one without terms.

    A map over rows: no shuffle. A column named score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the labelled sample

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        lx = shared.value
        return pd.Series([lx.score(*lx.weight(t or "")) for t in text], dtype="float64")

    return docs.withColumn("score", score(F.col("text")))


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with the columns they came with."""
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in docs.columns], F.col("text"))
    kept = score_toxicity(plain, lexicon).where(F.col("score") < threshold)
    return kept.select(*[F.col(f"`__{c}`").alias(c) for c in docs.columns])
