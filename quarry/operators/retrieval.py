"""Ranking, fusion, reranking, diversity and top-k as joins and windows.

A ranking is a DataFrame (qid, doc_id, score, rank). Ties go to the least doc_id, whatever the order of input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import jaccard, tokens
from quarry.operators.ivf import unit
from quarry.operators.lexical import LexicalIndex, query_terms, ranked, saturated
from quarry.session import broadcast_if_small, materialize

RRF_K = 60


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, tf, dl) of the documents, only for the terms asked for."""
    d = docs.select("doc_id", tokens(F.col("text")).alias("t"))
    d = d.select("doc_id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    return d.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term", "doc_id", "dl").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame | LexicalIndex, queries: DataFrame, k: int, allowed: DataFrame | None = None) -> DataFrame:
    """Okapi BM25 with the non-negative idf ln(1 + (N - df + 0.5) / (df + 0.5)); only positive scores rank. k <= 0: none.

    ``docs`` are documents or an index over them, which skips blocks and takes ``allowed`` (see ``LexicalIndex.search_with_cost``).
    """
    if isinstance(docs, LexicalIndex):
        return docs.search(queries, k, "bm25", allowed)
    qt = query_terms(queries)
    post = postings(docs, qt)
    stats = docs.agg(F.count("*").alias("n"), F.avg(F.size(tokens(F.col("text")))).alias("avgdl"))
    df = post.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats))
    idf = df.select("term", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), "avgdl")
    j = qt.join(idf, "term").join(post, "term")
    return ranked(j.groupBy("qid", "doc_id").agg(F.sum(F.col("qtf") * F.col("idf") * saturated(F.col("avgdl"))).alias("score")).where("score > 0"), max(k, 0))


def sparse(docs: DataFrame | LexicalIndex, queries: DataFrame, k: int, allowed: DataFrame | None = None) -> DataFrame:
    """Dot product of term counts over shared terms; ``docs`` are documents or an index over them."""
    if isinstance(docs, LexicalIndex):
        return docs.search(queries, k, "sparse", allowed)
    qt = query_terms(queries)
    j = qt.join(postings(docs, qt), "term")
    return ranked(j.groupBy("qid", "doc_id").agg(F.sum(F.col("qtf") * F.col("tf")).cast("double").alias("score")), k)


def dense(vectors: DataFrame, queries: DataFrame, k: int, block: int = 8_192, digits: int = 5) -> DataFrame:
    """Cosine top-k of (qid, vector) against (doc_id, vector): exact, in blocks of queries.

    A block (of fixed size) is broadcast; each task multiplies its batches by it and passes on its own k best a query,
    so what is shuffled is k rows a query and task, not the product. Null vectors, those of another length, of zero norm or
    with a null, NaN or infinite entry score 0, as queries do that have one. Rows without an id are left out; k <= 0: none.
    """
    spark, k, vectors, queries = vectors.sparkSession, max(k, 0), vectors.where("doc_id is not null"), queries.where("qid is not null")
    if k == 0:
        return ranked(vectors.sparkSession.createDataFrame([], "qid long, doc_id long, score double"), 0, digits)
    total = queries.count()
    blocks = max(1, -(-total // block))
    out = None
    for i in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i) if blocks > 1 else queries
        rows = part.collect()  # one block: of fixed size
        qids = np.array([r.qid for r in rows], dtype=np.int64)
        by_length: dict[int, tuple[list[int], list]] = {}  # queries of one length at a time
        for at, r in enumerate(rows):
            if r.vector and None not in r.vector:
                where = by_length.setdefault(len(r.vector), ([], []))
                where[0].append(at)
                where[1].append(r.vector)
        shared = spark.sparkContext.broadcast((qids, {n: (np.array(w), unit(np.array(v, dtype=float))) for n, (w, v) in by_length.items()}))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qid, queries_ = shared.value
            held: list[tuple] = []  # places of queries, documents and scores that may be among the best k
            size = 0

            def best() -> tuple:
                i, d, s = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((d, -s, i))
                i, d, s = i[order], d[order], s[order]
                first = np.searchsorted(i, i)
                keep = np.arange(len(i)) - first < k
                return i[keep], d[keep], s[keep]

            for b in batches:
                ids = b.column(0).to_numpy(zero_copy_only=False)
                vectors_ = b.column(1).to_pylist()
                length = np.array([len(v) if v and None not in v else 0 for v in vectors_])
                for at in range(0, len(ids), 2048):
                    s = np.zeros((len(qid), min(2048, len(ids) - at)))
                    for m, (where, q) in queries_.items():
                        fits = np.flatnonzero(length[at : at + 2048] == m)
                        if len(fits):
                            s[np.ix_(where, fits)] = np.round(q @ unit(np.array([vectors_[at + i] for i in fits], dtype=float)).T, digits)
                    n = s.shape[1]
                    least = np.partition(s, n - k, axis=1)[:, n - k] if n > k else np.full(len(s), -np.inf)
                    i, j = np.nonzero(s >= least[:, None])  # ties at the least stay until ids decide
                    held.append((i, ids[at : at + 2048][j], s[i, j]))
                    size += len(i)
                    if size > 8 * k * len(qid):
                        held = [best()]
                        size = len(held[0][0])
            if held:
                i, d, s = best()
                yield pa.RecordBatch.from_arrays([pa.array(qid[i]), pa.array(d), pa.array(s)], ["qid", "doc_id", "score"])

        top = vectors.select("doc_id", "vector").mapInArrow(run, "qid long, doc_id long, score double")
        out = top if out is None else out.union(top)
    return ranked(out, k, digits)


def rrf(*rankings: DataFrame, k: int, constant: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion: the sum of 1 / (constant + rank) over the rankings that have the document."""
    all_ = rankings[0].select("qid", "doc_id", "rank")
    for r in rankings[1:]:
        all_ = all_.unionByName(r.select("qid", "doc_id", "rank"))
    return ranked(all_.groupBy("qid", "doc_id").agg(F.sum(1 / (constant + F.col("rank"))).alias("score")), k)


def weighted(dense_: DataFrame, sparse_: DataFrame, weight: float, k: int) -> DataFrame:
    """weight * sparse + (1 - weight) * dense of scores scaled to 0..1 in each ranking; equal scores scale to 1, missing ones are 0."""

    def scaled(r: DataFrame, w: float) -> DataFrame:
        p = Window.partitionBy("qid")
        lo, hi = F.min("score").over(p), F.max("score").over(p)
        return r.select("qid", "doc_id", (w * F.when(hi == lo, 1.0).otherwise((F.col("score") - lo) / (hi - lo))).alias("score"))

    both = scaled(dense_, 1 - weight).unionByName(scaled(sparse_, weight))
    return ranked(both.groupBy("qid", "doc_id").agg(F.sum("score").alias("score")), k)


def dbsf(*rankings: DataFrame, k: int) -> DataFrame:
    """Distribution-based fusion: scores placed between mean - 3 and mean + 3 standard deviations, clipped, then summed."""
    parts = None
    for r in rankings:
        p = Window.partitionBy("qid")
        mean, sd = F.avg("score").over(p), F.coalesce(F.stddev_samp("score").over(p), F.lit(0.0))
        s = r.select("qid", "doc_id", F.when(sd == 0, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("score") - (mean - 3 * sd)) / (6 * sd)))).alias("score"))
        parts = s if parts is None else parts.unionByName(s)
    return ranked(parts.groupBy("qid", "doc_id").agg(F.sum("score").alias("score")), k)


def of_pool(pool: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a written pool of candidates names, picked by its ids where those are few, so the others are not shuffled."""
    ids = pool.select("doc_id").distinct()
    return docs.join(broadcast_if_small(ids, pool.count()), "doc_id", "left_semi")


def rerank(ranking: DataFrame, queries: DataFrame, docs: DataFrame | LexicalIndex, k: int, min_score: float = 0.0, scorer: Callable | None = None) -> DataFrame:
    """Rescore a pool and keep the k best at or above ``min_score``. scorer(query text, document text) is a column function; by
    default the Jaccard likeness of the token sets. Only the texts of the pool are moved: it is written and counted, and its ids pick them. An index has the token sets itself."""
    pool = materialize(ranking.select("qid", "doc_id"), "pool")
    own = queries.select("qid", F.col("text").alias("q"))
    if isinstance(docs, LexicalIndex):
        if scorer is not None:
            raise ValueError("a scorer of texts needs documents")
        texts = of_pool(pool, docs.forward.select("doc_id", "t")).select("doc_id", F.array_distinct("t").alias("d"))
    else:
        texts = of_pool(pool, docs.select("doc_id", "text")).select("doc_id", F.col("text").alias("d") if scorer else F.array_distinct(tokens(F.col("text"))).alias("d"))
    score = scorer or jaccard
    if scorer is None:  # token sets once a text, not once a pair
        own = own.withColumn("q", F.array_distinct(tokens(F.col("q"))))
    j = pool.join(own, "qid").join(texts, "doc_id")
    return ranked(j.select("qid", "doc_id", score(F.col("q"), F.col("d")).alias("score")).where(F.col("score") >= min_score), k)


def cap_per_key(ranking: DataFrame, key: str, cap: int, k: int) -> DataFrame:
    """At most ``cap`` of a key in rank order, then the first k, ranked anew."""
    w = Window.partitionBy("qid", key).orderBy("rank")
    kept = ranking.withColumn("n", F.row_number().over(w)).where(F.col("n") <= cap).drop("n")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("rank"))).where(F.col("rank") <= k)


def pin(pinned: DataFrame, ranking: DataFrame, k: int) -> DataFrame:
    """(qid, doc_id, rank): pinned first in their order, then the ranking without them."""
    both = pinned.select("qid", "doc_id", "rank", F.lit(0).alias("p")).unionByName(ranking.select("qid", "doc_id", "rank", F.lit(1).alias("p")))
    first = both.groupBy("qid", "doc_id").agg(F.min(F.struct("p", "rank")).alias("at"))
    return first.select("qid", "doc_id", F.row_number().over(Window.partitionBy("qid").orderBy("at.p", "at.rank", "doc_id")).alias("rank")).where(F.col("rank") <= k)


def union_candidates(branches: list[DataFrame]) -> DataFrame:
    """Candidates of all branches once, where the earliest branch and rank has them."""
    all_ = None
    for i, b in enumerate(branches):
        b = b.select("qid", "doc_id", F.lit(i).alias("branch"), F.col("rank").alias("branch_rank"))
        all_ = b if all_ is None else all_.unionByName(b)
    first = all_.groupBy("qid", "doc_id").agg(F.min(F.struct("branch", "branch_rank")).alias("at")).select("qid", "doc_id", "at.*")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("branch", "branch_rank", "doc_id")))


def mmr(pool: DataFrame, k: int, lam: float = 0.5, cap: int | None = None) -> DataFrame:
    """Maximal marginal relevance over a pool (qid, doc_id, rank, score, vector[, key]); pools are bounded by their depth.

    Picks the item with the greatest lam * score - (1 - lam) * likeness to what is picked; ties to the earliest. ``cap`` limits a key.
    Without vectors the order stays.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank").reset_index(drop=True)
        v = None
        if pdf["vector"].notna().all() and len(pdf):
            v = np.array(pdf["vector"].tolist(), dtype=float)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        chosen: list[int] = []
        used: dict = {}
        keys = pdf["key"].to_numpy()
        value = lam * pdf["score"].to_numpy(dtype=float) if v is not None else -np.arange(len(pdf), dtype=float)
        near, free = np.zeros(len(pdf)), np.ones(len(pdf), bool)  # likeness to what is picked: a running maximum
        while len(chosen) < min(k, len(pdf)):
            left = np.where(free, value - (1 - lam) * near, -np.inf)
            if not np.isfinite(left.max(initial=-np.inf)):
                break
            at = int(np.flatnonzero(left >= left.max() - 1e-12)[0])
            chosen.append(at)
            free[at] = False
            used[keys[at]] = used.get(keys[at], 0) + 1
            if cap and used[keys[at]] >= cap:
                free &= keys != keys[at]
            if v is not None:
                like = v @ v[at]
                near = like if len(chosen) == 1 else np.maximum(near, like)
        return pd.DataFrame({"qid": pdf["qid"].iloc[chosen], "doc_id": pdf["doc_id"].iloc[chosen], "rank": np.arange(1, len(chosen) + 1, dtype="int32")})

    pool = pool if "key" in pool.columns else pool.withColumn("key", F.lit(""))
    return pool.groupBy("qid").applyInPandas(pick, "qid long, doc_id long, rank int")


def token_budget(ranking: DataFrame, budget: int) -> DataFrame:
    """Greedy packing of (qid, doc_id, rank, tokens): an item that does not fit is skipped; if the first does not fit, nothing is taken."""

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        left, rows = budget, []
        for i, (d, n) in enumerate(zip(pdf["doc_id"], pdf["tokens"], strict=True)):
            if n <= left:
                left -= n
                rows.append((d, n, budget - left))
            elif i == 0:
                break
        q = pdf["qid"].iloc[0]
        return pd.DataFrame([(q, d, len(rows[: j + 1]), n, u) for j, (d, n, u) in enumerate(rows)], columns=["qid", "doc_id", "position", "tokens", "used"])

    return ranking.groupBy("qid").applyInPandas(take, "qid long, doc_id long, position int, tokens long, used long")
