"""Approximate dense search: an inverted file of coarse cells with 8-bit codes, probed, then rescored exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.lexical import ranked
from quarry.session import broadcast_if_small, materialize

SAMPLE = 20_000  # vectors that the cells are learned from, at most
ROUNDS = 10
RUN_ROWS = 4_096  # rows of a cell that one task compares with one run of queries
QUERY_RUN = 256


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros, or with a NaN or an infinity, become zeros."""
    v = np.where(np.isfinite(v).all(axis=1, keepdims=True), v, 0.0)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def fit_cells(v: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means of unit vectors; empty cells take the vectors that lie worst."""
    rnd = np.random.default_rng(seed)
    c = v[rnd.choice(len(v), min(cells, len(v)), replace=False)]
    for _ in range(ROUNDS):
        like = v @ c.T
        own = like.argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, v)
        empty = np.flatnonzero(np.bincount(own, minlength=len(c)) == 0)
        sums[empty] = v[np.argsort(like.max(1))[: len(empty)]]
        c = unit(sums)
    return c


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Unit rows of the vectors of length ``d``; others, and those with a null, are zeros."""
    out = np.zeros((len(column), d))
    rows = column.to_pylist()
    fits = [i for i, v in enumerate(rows) if v is not None and len(v) == d and None not in v]
    if fits:
        out[fits] = unit(np.array([rows[i] for i in fits], dtype=float))
    return out


class InvertedFile:
    """Every row of (doc_id, vector) under its nearest of about sqrt(n) cells, with an 8-bit code and the vector beside it.

    Cells are learned from ``sample`` vectors at most; all rows are indexed. ``lists`` (cell, part, doc_id, code, scale, vector) is
    written sorted by cell, so a search skips row groups of others; a large cell is many parts. Null vectors, and those of
    another length than most or of no direction, score 0 against everything: they are in ``rest`` and complete short results.
    """

    def __init__(self, vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE, seed: int = 7):
        rows = vectors.where("doc_id is not null").select("doc_id", "vector")
        n = rows.count()
        length = rows.where("vector is not null").groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        self.d = d = length.d if length else 0
        some = rows.where(F.size("vector") == d).orderBy(F.xxhash64("doc_id")).limit(sample).select("vector").toArrow() if d else None  # of fixed size
        v = matrix(some.column(0).combine_chunks(), d) if some is not None else np.zeros((0, 0))
        v = v[np.abs(v).sum(1) > 0]
        self.centres = fit_cells(v, cells or max(1, int(np.sqrt(n))), seed) if len(v) else np.zeros((0, d))
        centres = self.centres

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = matrix(b.column(1), d)
                lost = np.abs(x).sum(1) == 0
                cell = np.where(lost, -1, (x @ centres.T).argmax(1) if len(centres) else -1)
                scale = np.abs(x).max(axis=1, initial=0) / 127
                code = np.round(x / np.maximum(scale, 1e-300)[:, None]).astype(np.int8)
                yield pa.record_batch([b.column(0), b.column(1), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale)], names=["doc_id", "vector", "cell", "code", "scale"])

        kinds = dict(rows.dtypes)
        held = materialize(rows.mapInArrow(assign, f"doc_id {kinds['doc_id']}, vector {kinds['vector']}, cell int, code binary, scale double"), "assigned")
        self.rest = held.where("cell < 0").select("doc_id")
        part = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.ceil(F.col("n") / RUN_ROWS)))
        sizes = held.groupBy("cell").agg(F.count("*").alias("n"))
        self.lists = materialize(held.where("cell >= 0").join(broadcast_if_small(sizes, len(centres) + 1), "cell").withColumn("part", part.cast("int")).drop("n").repartition("cell", "part").sortWithinPartitions("cell", "part"), "lists")

    def search(self, queries: DataFrame, k: int, probes: int = 8, depth: int | None = None, digits: int = 5) -> DataFrame:
        """(qid, doc_id, score, rank) by cosine for (qid, vector).

        A query meets the codes of its ``probes`` nearest cells; the best ``depth`` (8 k unless given) by code of each part are
        rescored with their vectors. With as many probes as cells and no depth limit (``depth`` 0) the result is exact: that
        of ``retrieval.dense``. Queries of another length or without a direction meet only ``rest``.
        """
        d, centres, depth = self.d, self.centres, 8 * k if depth is None else depth
        probes = min(max(probes, 1), len(centres))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = matrix(b.column(1), d)
                fine = np.flatnonzero(np.abs(x).sum(1) > 0)
                if not len(fine):
                    continue
                near = np.argpartition(-(x[fine] @ centres.T), probes - 1, axis=1)[:, :probes]
                at = np.repeat(fine, probes)
                yield pa.record_batch([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(near.ravel(), pa.int32())], names=["qid", "query", "cell"])

        q = queries.where("qid is not null").select("qid", "vector")
        kinds = dict(q.dtypes)
        if not probes or k <= 0:
            return ranked(q.select("qid").join(self.lists.select("doc_id").limit(0)).withColumn("score", F.lit(0.0)), 0)
        asked = materialize(q.mapInArrow(probe, f"qid {kinds['qid']}, query {kinds['vector']}, cell int"), "probes")
        cells = [r[0] for r in asked.select("cell").distinct().collect()]  # cells, at most
        runs = asked.join(self.lists.where(F.col("cell").isin(cells)).select("cell", "part").distinct(), "cell")

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            qid, ids = left.column("qid"), right.column("doc_id")
            x, found = matrix(left.column("query").combine_chunks(), d), []
            if len(ids) and len(qid):
                code = np.frombuffer(b"".join(right.column("code").to_pylist()), np.int8).reshape(-1, d).astype(np.float32) * right.column("scale").to_numpy()[:, None].astype(np.float32)
                exact = matrix(right.column("vector").combine_chunks(), d)
                number = ids.to_numpy()
                for at in range(0, len(x), QUERY_RUN):
                    part = x[at : at + QUERY_RUN]
                    if depth and depth < len(code):
                        like = part.astype(np.float32) @ code.T
                        near = np.argpartition(-like, depth - 1, axis=1)[:, :depth]
                        score = np.round(np.einsum("qd,qkd->qk", part, exact[near]), digits)
                    else:
                        near, score = np.broadcast_to(np.arange(len(code)), (len(part), len(code))), np.round(part @ exact.T, digits)
                    for i in range(len(part)):
                        first = np.lexsort((number[near[i]], -score[i]))[:k]
                        found += [(at + i, near[i][j], score[i][j]) for j in first]
            i, j, s = zip(*found, strict=True) if found else ((), (), ())
            return pa.table({"qid": qid.take(pa.array(i, pa.int64())), "doc_id": ids.take(pa.array(j, pa.int64())), "score": pa.array(s, pa.float64())})

        lists = self.lists.where(F.col("cell").isin(cells))
        ids = dict(self.lists.dtypes)["doc_id"]
        best = runs.groupBy("cell", "part").cogroup(lists.withColumnsRenamed({"cell": "c", "part": "p"}).groupBy("c", "p")).applyInArrow(compare, f"qid {kinds['qid']}, doc_id {ids}, score double")
        zero = self.rest.orderBy("doc_id").limit(k)  # what scores 0 whatever the query
        none = q.select("qid").crossJoin(F.broadcast(zero)).withColumn("score", F.lit(0.0))  # k rows a query
        return ranked(best.unionByName(none), k, digits)
