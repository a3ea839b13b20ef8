"""Quality: ordinal cumulative-link regression on graded ratings with shared hashed-text weights."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 8_000  # graded rows the weights are fitted to, at most
BUCKETS = 1 << 16
KEEP = 0.35  # least probability of the wanted grade for a document to be kept
WORDS_KEPT = 100_000  # words a worker remembers before it starts afresh; a speed bound only

_RUNS = re.compile(r"(.)\1+", re.S)


class _Shapes(dict):
    """For str.translate: lower letters to a, capitals to A, digits to 9; other characters stay."""

    def __missing__(self, c: int) -> str:
        x = chr(c)
        self[c] = x = "A" if x.isupper() else "a" if x.isalpha() else "9" if x.isdigit() else x
        return x


class Features:
    """Sparse hashed features of a whole text: word shapes, words and the text's own proportions in steps."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = buckets
        self.shapes = _Shapes()
        self.words: dict[str, int] = {}
        self.runs: dict[str, int] = {}

    def _at(self, name: str) -> int:
        return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) % self.buckets

    def _counts(self, names: list[str], known: dict[str, int], hashed) -> tuple[list[int], list[int]]:
        counts = Counter(names)
        if len(known) > WORDS_KEPT:
            known.clear()
        for x in set(counts).difference(known):
            known[x] = self._at(hashed(x))
        return [known[x] for x in counts], list(counts.values())

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words, drawn = text.split(), text.translate(self.shapes)
        n, chars = len(words), max(1, len(text))
        wi, wk = self._counts(words, self.words, lambda w: "w" + w.lower())
        si, sk = self._counts(drawn.split(), self.runs, lambda s: "s" + _RUNS.sub(r"\1", s))
        idx, where = np.unique(np.array(wi + si, dtype=np.int64), return_inverse=True)
        val = np.sqrt(np.bincount(where, np.array(wk + sk, dtype=float), len(idx)) / max(1, n))
        upper = drawn.count("A")
        letters = drawn.count("a") + upper
        steps = {
            "long": int(math.log2(n + 1)),
            "distinct": int(10 * len(wk) / max(1, n)),
            "repeat": int(10 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, n)),
            "letters": int(20 * letters / chars),
            "upper": int(10 * upper / max(1, letters)),
            "width": min(20, int(letters / max(1, n))),
            "lines": min(20, int(100 * text.count("\n") / max(1, n))),
            "top": int(10 * max(wk, default=0) / max(1, n)),
        }
        more = np.array([self._at(f"{a}={b}") for a, b in steps.items()])
        return np.concatenate([idx, more]), np.concatenate([val, np.ones(len(more))])


@dataclass
class Ordinal:
    """P(grade > grades[k]) = sigmoid(weights . x - cuts[k]), with increasing cuts."""

    grades: tuple[int, ...]
    cuts: np.ndarray
    weights: np.ndarray

    def above(self, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[idx] @ val - self.cuts, -40, 40)))

    def rate(self, idx: np.ndarray, val: np.ndarray, wanted: int) -> tuple[float, float]:
        """(expected grade, probability of a grade of ``wanted`` at least)."""
        above = self.above(idx, val)
        mean = self.grades[0] + float(np.diff(self.grades) @ above)
        tail = [1.0, *map(float, above)]
        return mean, next((p for g, p in zip(self.grades, tail, strict=True) if g >= wanted), 0.0)


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, epochs: int = 12, rate: float = 0.3, ridge: float = 2e-4) -> Ordinal:
    """Adaptive stochastic gradients on the likelihood of the grades; cuts stay ordered as a first one and positive steps."""
    grades = tuple(sorted({r[2] for r in rows})) or (0,)
    levels = len(grades)
    share = np.array([sum(r[2] > g for r in rows) for g in grades[:-1]]) / max(1, len(rows))
    cuts = -np.log(share / (1 - share)) if levels > 1 else np.zeros(0)
    w = np.zeros(buckets)
    if levels < 2:
        return Ordinal(grades, cuts, w)
    first, steps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-3))
    gw, gc = np.full(buckets, 1e-6), np.full(levels - 1, 1e-6)
    at = {g: i for i, g in enumerate(grades)}
    order, rnd = np.arange(len(rows)), np.random.default_rng(7)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(epochs):
        rnd.shuffle(order)
        for i in order:
            idx, val, y = rows[i]
            k = at[y]
            cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
            eta = w[idx] @ val
            p = sigmoid(eta - cuts)
            hi, lo = (p[k - 1] if k else 1.0), (p[k] if k < levels - 1 else 0.0)
            like = max(hi - lo, 1e-9)
            dhi, dlo = (hi * (1 - hi) if k else 0.0), (lo * (1 - lo) if k < levels - 1 else 0.0)
            g = -(dhi - dlo) / like
            dw = g * val + ridge * w[idx]
            np.add.at(gw, idx, dw * dw)
            w[idx] -= rate * dw / np.sqrt(gw[idx])
            dc = np.zeros(levels - 1)
            if k:
                dc[k - 1] += dhi / like
            if k < levels - 1:
                dc[k] -= dlo / like
            d = np.concatenate([[dc.sum()], [dc[j + 1 :].sum() * math.exp(steps[j]) for j in range(levels - 2)]])
            gc += d * d
            d = 0.1 * d / np.sqrt(gc)
            first, steps = first - d[0], steps - d[1:]
    return Ordinal(grades, first + np.concatenate([[0.0], np.cumsum(np.exp(steps))]), w)


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> Ordinal:
    """Fit to the graded rows of ``labels`` (doc_id and an integer grade): any number of grades, each value a level.

    At most about ``sample_rows`` rows, the first by a hash of doc_id, are used, each with its whole text. Null ids, grades and
    texts are ignored; of repeated grades of a document the greatest counts. One grade or none gives a model that
    is certain of it.
    """
    own = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
    n = own.count()
    if n > sample_rows:
        own = own.where(F.pmod(F.xxhash64(F.lit("graded"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
    own = own.withColumnRenamed("doc_id", "__id")
    sample = docs.select("doc_id", "text").join(F.broadcast(own), F.col("doc_id") == F.col("__id")).where("text is not null").select("text", "__y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features(buckets)
        for b in batches:
            got = [f(t.as_py()) for t in b.column(0)]
            packed = [pa.array([g[k].astype(t).tobytes() for g in got], pa.binary()) for k, t in ((0, "<i4"), (1, "<f4"))]
            yield pa.RecordBatch.from_arrays([*packed, b.column(1)], ["i", "v", "y"])

    found = sample.mapInArrow(extract, "i binary, v binary, y int").collect()  # at most sample_rows of a few KB
    rows = [(np.frombuffer(r.i, "<i4"), np.frombuffer(r.v, "<f4").astype(float), r.y) for r in found]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))  # one fit whatever the order of rows
    return fit_ordinal(rows, buckets)


def score_quality(docs: DataFrame, model: Ordinal, wanted: int | None = None) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of the grade ``wanted``, the greatest unless given).

    Null text is scored as empty text. A map over rows without a shuffle; columns of those names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of buckets
    wanted = model.grades[-1] if wanted is None else wanted
    buckets = len(model.weights)

    @F.pandas_udf("struct<e:double,t:double>")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = Features(buckets)
        for text in batches:
            yield pd.DataFrame([shared.value.rate(*f(t or ""), wanted) for t in text], columns=["e", "t"], dtype="float64")

    names = [c for c in docs.columns if c not in ("expected_grade", "tail_probability")]
    out = docs.select(*[F.col(f"`{c}`") for c in names], rate(F.col("text")).alias("__rated"))
    return out.select(*[F.col(f"`{c}`") for c in names], F.col("__rated.e").alias("expected_grade"), F.col("__rated.t").alias("tail_probability"))


def keep_good(docs: DataFrame, model: Ordinal, least: float = KEEP, wanted: int | None = None) -> DataFrame:
    """The documents whose tail probability is at least ``least``, with the columns they came with."""
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in docs.columns], F.col("text"))
    kept = score_quality(plain, model, wanted).where(F.col("tail_probability") >= least)
    return kept.select(*[F.col(f"`__{c}`").alias(c) for c in docs.columns])
