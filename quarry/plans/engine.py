"""One object for the questions a user asks of a corpus: search, lookup, browse, document, versions, status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.chunking import chunk_documents, reassemble
from quarry.operators import retrieval as R
from quarry.operators.governance import browse, filters, named_filter
from quarry.session import materialize


class Engine:
    """Over ``docs``: doc_id, text and any columns to filter by; ``index``: an index over them that has these columns. Every answer is a DataFrame; nothing is collected."""

    def __init__(self, docs: DataFrame, index: R.LexicalIndex | None = None):
        self.docs, self.index = docs, index
        self.spark: SparkSession = docs.sparkSession

    def _filtered(self, **where) -> DataFrame:
        c: Column | None = filters(**where)
        return self.docs if c is None else self.docs.where(c)

    def _both(self, words, questions: DataFrame, depth: int, allowed: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return R.bm25(words, questions, depth, allowed), R.sparse(words, questions, depth, allowed)

    def _within(self, condition: Column | None, contains: str | None = None) -> tuple[DataFrame | R.LexicalIndex, DataFrame | None]:
        """What to search, and among which of its rows: the index, which evaluates the condition itself, or documents."""
        if self.index is not None:
            allowed = self.index.allowed(condition, contains)
            return self.index, None if allowed is None else materialize(allowed, "allowed")
        d = self.docs if condition is None else self.docs.where(condition)
        words = [w for w in (contains or "").lower().split()]
        return (d.where(filters(text__text=" ".join(words))) if words else d), None

    def search(self, questions: DataFrame, k: int = 10, mode: str = "hybrid", pool: int | None = None, min_score: float = 0.0, max_per: tuple[str, int] | None = None, pinned: DataFrame | None = None, named: dict | None = None, columns: dict[str, str] | None = None, **where) -> DataFrame:
        """(qid, doc_id, score, rank) for (qid, text). Modes: bm25, sparse, hybrid (both, fused by rank), reranked (hybrid, then token likeness).

        The pool is max(5 k, 50) deep unless given. ``max_per`` = (column, cap) limits a key; ``pinned`` (qid, doc_id, rank) comes first.
        Filters: ``where`` as in ``governance.filters``, ``named`` (with ``columns``) as in ``governance.named_filter``. With an index
        that has their columns, no document text is read; weights are then those of all documents.
        """
        depth, c = pool or max(5 * k, 50), filters(**where)
        named_c, contains = named_filter(named or {}, columns)
        if named_c is not None:
            c = named_c if c is None else c & named_c
        words, allowed = self._within(c, contains)
        one = {"bm25": R.bm25, "sparse": R.sparse}.get(mode)
        out = one(words, questions, depth, allowed) if one else R.rrf(*self._both(words, questions, depth, allowed), k=depth)
        if mode == "reranked":
            out = R.rerank(out, questions, words, depth, min_score)
        if max_per:
            key, cap = max_per
            out = materialize(out, "pool")
            keyed = self.index.forward if self.index is not None and key in self.index.columns else self.docs
            out = R.cap_per_key(out.join(R.of_pool(out, keyed.select("doc_id", key)), "doc_id"), key, cap, depth)
        if pinned is not None:
            order = R.pin(pinned, out, k)
            out = order.join(out.select("qid", "doc_id", "score"), ["qid", "doc_id"], "left")
        return out.where(F.col("rank") <= k).select("qid", "doc_id", "score", "rank")

    def accurate(self, questions: DataFrame, exact: DataFrame | None = None, as_of: Column | None = None, k: int = 10, pool: int = 50, min_score: float = 0.0) -> DataFrame:
        """Several branches, one answer: exact matches (qid, doc_id), both lexical rankings, then what is admissible, then a rescoring.

        ``docs`` may have ``content_complete`` (rows that are not are left out) and effective_from / effective_to (only rows in force at
        ``as_of`` stay). With an index over these columns no text is read. Returns (qid, doc_id, score, rank, branch); a question
        without rows is for ``abstentions``.
        """
        fit = [F.coalesce("content_complete", F.lit(False))] if "content_complete" in self.docs.columns else []
        if as_of is not None:
            fit.append((F.col("effective_from") <= as_of) & (F.col("effective_to").isNull() | (F.col("effective_to") > as_of)))
        words, allowed = self._within(reduce(lambda a, b: a & b, fit) if fit else None)
        branches = list(self._both(words, questions, pool, allowed))
        if exact is not None:
            rows = allowed if allowed is not None else words.forward if self.index is not None else words
            branches.insert(0, exact.select("qid", "doc_id").distinct().join(rows.select("doc_id"), "doc_id", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("doc_id"))))
        found = materialize(R.union_candidates(branches), "candidates")
        out = R.rerank(found, questions, words, k, min_score)
        return out.join(found.select("qid", "doc_id", "branch"), ["qid", "doc_id"])

    def abstentions(self, questions: DataFrame, hits: DataFrame) -> DataFrame:
        """(qid, reason): questions that have no hit, which are to be answered by no one."""
        return questions.select("qid").join(hits.select("qid").distinct(), "qid", "left_anti").withColumn("reason", F.lit("no_evidence"))

    def lookup(self, **where) -> DataFrame:
        """Exact lookup by at least one filter."""
        if filters(**where) is None:
            raise ValueError("a lookup needs at least one filter")
        return self._filtered(**where)

    def browse(self, order: list[Column], offset: int = 0, limit: int = 20, **where) -> DataFrame:
        return browse(self._filtered(**where), order, offset, limit)

    def document(self, doc_id: int, **budget) -> DataFrame:
        """A document's chunks, each with what it adds to those before it; joined in order they are the document."""
        c = chunk_documents(self.docs.where(F.col("doc_id") == doc_id), **budget)
        return c.drop("text").join(reassemble(c).withColumnRenamed("piece_index", "chunk_index"), ["doc_id", "chunk_index"])

    def context(self, chunks: DataFrame, hits: DataFrame, neighbours: int = 1) -> DataFrame:
        """The hit chunks (doc_id, chunk_index) and up to ``neighbours`` on either side, each once."""
        near = hits.select("doc_id", F.explode(F.sequence(F.col("chunk_index") - neighbours, F.col("chunk_index") + neighbours)).alias("chunk_index")).distinct()
        return chunks.join(near, ["doc_id", "chunk_index"])

    def status(self, by: str = "source") -> DataFrame:
        """Rows by group, and over all (group null)."""
        return self.docs.rollup(by).agg(F.count("*").alias("n"))

    def versions(self, code: str, date: str) -> DataFrame:
        """Documents that share a code, newest first; without a code a document stands alone."""
        key = F.coalesce(F.col(code), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")))
        w = Window.partitionBy("family").orderBy(F.desc_nulls_last(date), "doc_id")
        return self.docs.withColumn("family", key).withColumn("position", F.row_number().over(w))
