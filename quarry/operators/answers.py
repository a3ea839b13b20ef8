"""Answers: translation, weighted bags of words, documents stitched from overlapping pieces, and ask: retrieve, compose, validate or abstain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.parse import query_plan
from quarry.operators.lexical import NORMS
from quarry.operators.retrieval import LexicalIndex, query_terms, ranked
from quarry.session import broadcast_if_small, materialize


def translated(queries: DataFrame, mapping: DataFrame, needed: Column, strict: bool = False) -> DataFrame:
    """(qid, text) with ``query``: the mapped text (mapping: text, target) where ``needed``, else the text itself.

    A needed text without a mapping keeps a null query; with ``strict`` it fails the job.
    """
    m = mapping.groupBy(F.col("text").alias("__text")).agg(F.min("target").alias("__target"))
    j = queries.join(broadcast_if_small(m, mapping.count()), F.col("text") == F.col("__text"), "left")
    miss = F.raise_error(F.concat(F.lit("no translation of: "), "text")).cast("string") if strict else F.lit(None).cast("string")
    q = F.when(~needed, F.col("text")).when(F.col("__text").isNotNull(), F.col("__target")).otherwise(miss)
    return j.withColumn("query", q).drop("__text", "__target")


def idf_cosine(index: LexicalIndex, queries: DataFrame, k: int) -> DataFrame:
    """Top k by the cosine of bags of words weighted by tf * ln(1 + N / df). Terms that no document has count in no vector."""
    qt = query_terms(queries.where("qid is not null"))
    idf = index.terms.select("term", "df", F.log(1 + F.lit(float(index.n)) / F.col("df")).alias("idf"))
    q = materialize(qt.join(idf, "term").select("qid", "term", (F.col("qtf") * F.col("idf")).alias("qw"), "idf", "df"), "weights")
    q_norm = q.groupBy("qid").agg(F.sqrt(F.sum(F.pow("qw", 2))).alias("qn"))
    w = q.join(q_norm, "qid").select("qid", "term", (F.col("qw") * F.col("idf") / F.col("qn")).alias("w"), "df", F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("least"))
    found = index.scored(w, max(k, 0), "most_tf", False, [(NORMS, index.norms)], skip=False)
    return ranked(found.where("doc_id is not null").select("qid", "doc_id", "score"), k)


def overlap(before: Column, after: Column, most: Column) -> Column:
    """Length of the longest end of ``before`` that ``after`` starts with, up to ``most`` characters."""
    n = F.greatest(F.least(F.length(before), F.length(after), most), F.lit(0))
    fits = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(after, F.lit(1), i) == F.substring(before, F.length(before) - i + 1, i))
    return F.array_max(fits)


def stitch(pieces: DataFrame) -> DataFrame:
    """(doc_id, text) of pieces (doc_id, piece, start, end, text) in order: where offsets overlap, the text that repeats is dropped, but no more than they say;
    else a blank line stands between."""
    w = Window.partitionBy("doc_id").orderBy("piece")
    p = pieces.withColumn("__t", F.lag("text").over(w)).withColumn("__e", F.lag("end").over(w))
    part = F.when(F.col("__t").isNull(), F.col("text")).when(F.col("start") <= F.col("__e"), F.substring(F.col("text"), overlap(F.col("__t"), F.col("text"), F.col("__e") - F.col("start")) + 1, F.length("text"))).otherwise(F.concat(F.lit("\n\n"), "text"))
    parts = p.select("doc_id", F.struct("piece", part.alias("part")).alias("x")).groupBy("doc_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # one document's own pieces
    return parts.select("doc_id", F.array_join(F.transform("xs", lambda x: x["part"]), "").alias("text"))


def ask(questions: DataFrame, search: Callable[[DataFrame], DataFrame], docs: DataFrame, compose: Callable[[Column, Column], Column], declared: Column | None = None, min_score: float = 0.0) -> DataFrame:
    """(qid, status, reason, doc_id, answer) of each question: answer, clarify or abstain.

    ``search`` gives (qid, doc_id, score, rank); ``compose``(question, evidence) is a column with a quotation of the evidence. A
    question in an unsupported language is to be clarified and is not searched for. Without evidence of ``min_score``, or with
    an answer that its evidence does not hold word for word, nothing is said.
    """
    q = questions.withColumn("plan", query_plan(F.col("text"), declared)).select("qid", "text", "plan")
    fit = q.where(F.col("plan.language") != "unsupported")
    top = search(fit.select("qid", "text")).where((F.col("rank") == 1) & (F.col("score") >= min_score)).select("qid", "doc_id")
    e = top.join(docs.select("doc_id", F.col("text").alias("evidence")), "doc_id").join(fit.select("qid", "text"), "qid")
    e = e.withColumn("answer", compose(F.col("text"), F.col("evidence")))
    e = e.withColumn("held", F.coalesce(F.contains(F.col("evidence"), F.col("answer")) & (F.trim("answer") != ""), F.lit(False)))
    j = q.join(e.select("qid", "doc_id", "answer", "held"), "qid", "left")
    reason = F.when(F.col("plan.language") == "unsupported", "unsupported_language").when(F.col("doc_id").isNull(), "no_evidence").when(~F.col("held"), "unsupported_claim")
    status = F.when(reason.isNull(), "answer").when(reason == "unsupported_language", "clarify").otherwise("abstain")
    good = status == "answer"
    return j.select("qid", status.alias("status"), reason.alias("reason"), F.when(good, F.col("doc_id")).alias("doc_id"), F.when(good, F.col("answer")).alias("answer"))
