"""Identity resolution, answer validation, release decisions and data-set lint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.operators.evaluation import wilson
from quarry.operators.governance import violations
from quarry.operators.selection import first_by_hash, kth_values
from quarry.operators.setjoin import set_join


def resolve_citations(refs: DataFrame, docs: DataFrame, limit: int = 3) -> DataFrame:
    """refs (qid, value, priority: lower first) against docs (doc_id, code): the matches of the first alternate that has any.

    One document: confidence 1; several: ambiguous, 1 / max(n, 2), and the first ``limit`` by id. No match, no row.
    """
    hit = refs.join(docs, refs.value == docs.code).select("qid", "doc_id", "priority").distinct()
    best = hit.groupBy("qid").agg(F.min("priority").alias("priority"))
    own = hit.join(best, ["qid", "priority"])
    n = own.groupBy("qid").agg(F.count_distinct("doc_id").alias("n"))
    w = Window.partitionBy("qid").orderBy("doc_id")
    out = own.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).join(n, "qid")
    return out.select("qid", "doc_id", "rank", (F.col("n") > 1).alias("ambiguous"), F.round(F.when(F.col("n") == 1, 1.0).otherwise(1 / F.greatest(F.col("n"), F.lit(2))), 6).alias("confidence"))


def select_temporal(candidates: DataFrame, as_of: Column) -> DataFrame:
    """Candidates in force: normative rows of documents with exactly one version at ``as_of``; others pass. Flagged where several are."""
    live = (F.col("effective_from") <= as_of) & (F.col("effective_to").isNull() | (F.col("effective_to") > as_of)) & F.col("version_id").isNotNull()
    c = candidates.where(~F.col("normative") | F.coalesce(live, F.lit(False)))
    w = Window.partitionBy("doc_id")
    one = ~F.col("normative") | (F.min(F.when(F.col("normative"), F.col("version_id"))).over(w) == F.max(F.when(F.col("normative"), F.col("version_id"))).over(w))
    return c.withColumn("unambiguous", one)


def validate_claims(claims: DataFrame, evidence: DataFrame, as_of: Column) -> DataFrame:
    """(claim_id, code) of claims (claim_id, evidence_id, quote, quote_start, effective) that their evidence does not bear out."""
    j = claims.join(evidence.select("evidence_id", F.col("text").alias("__text"), F.col("valid_from").alias("__from")), "evidence_id", "left")
    said = F.expr("substring(__text, quote_start + 1, length(quote))")
    checks = {"no_evidence": F.col("__text").isNull(), "empty_quote": F.coalesce(F.length("quote"), F.lit(0)) == 0, "quote_differs": F.col("__text").isNotNull() & (said != F.col("quote")), "not_effective": F.col("__from") > as_of}
    return violations(j, ["claim_id"], checks)


def claim_coverage(claims: DataFrame, bad: DataFrame, by: str) -> DataFrame:
    """(by, claims, supported, coverage)."""
    j = claims.select(by, "claim_id").join(bad.select("claim_id").distinct().withColumn("__bad", F.lit(1)), "claim_id", "left")
    return j.groupBy(by).agg(F.count("*").alias("claims"), F.count_if(F.col("__bad").isNull()).alias("supported"), F.round(F.avg(F.col("__bad").isNull().cast("double")), 6).alias("coverage"))


def release_gate(outcomes: DataFrame, least_answers: int = 1000, severe: float = 0.01, material: float = 0.03, least_coverage: float = 0.5, latency: float = 30.0) -> DataFrame:
    """Per candidate over (candidate, cluster, answered, severe, material, seconds): the upper error limits, the greater of those by answer
    and by cluster (erroneous if any answered member is), coverage, p95 seconds and whether every gate passes."""
    a = outcomes.where("answered")
    q = a.groupBy("candidate").agg(F.count("*").alias("answers"), F.count_if("severe").alias("s"), F.count_if("material").alias("m"), F.count("seconds").alias("timed"))
    ranks = q.where("timed > 0").select("candidate", F.lit(0).alias("slot"), (F.ceil(0.95 * F.col("timed") - 1e-9) - 1).alias("rank"))
    q = q.join(kth_values(a, ["candidate"], "seconds", ranks).select("candidate", F.col("value").alias("p95")), "candidate", "left").drop("timed")
    c = a.groupBy("candidate", "cluster").agg(F.bool_or("severe").alias("s"), F.bool_or("material").alias("m")).groupBy("candidate").agg(F.count("*").alias("clusters"), F.count_if("s").alias("cs"), F.count_if("m").alias("cm"))
    all_ = outcomes.groupBy("candidate").agg(F.round(F.avg(F.col("answered").cast("double")), 6).alias("coverage"))
    j = all_.join(q, "candidate", "left").join(c, "candidate", "left").na.fill(0, ["answers", "s", "m", "clusters", "cs", "cm"])
    up = lambda k, ck: F.greatest(wilson(F.col(k), F.col("answers")), wilson(F.col(ck), F.col("clusters")))
    j = j.withColumn("severe_limit", up("s", "cs")).withColumn("material_limit", up("m", "cm"))
    ok = (F.col("answers") >= least_answers) & (F.col("severe_limit") < severe) & (F.col("material_limit") < material) & (F.col("coverage") >= least_coverage) & (F.col("p95") <= latency)
    return j.select("candidate", "answers", "coverage", "p95", "severe_limit", "material_limit", F.coalesce(ok, F.lit(False)).alias("passes"))


def winner(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The first row by a lexicographic order."""
    return rows.orderBy(*order).limit(1)


def hard_negatives(pool: DataFrame, limit: int) -> DataFrame:
    """(qid, doc_id, kind, pick) of a pool (qid, doc_id, kind, priority, hash): the best of each kind first, then by priority; equal texts once."""
    once = pool.withColumn("d", F.row_number().over(Window.partitionBy("qid", "hash").orderBy("priority", "doc_id"))).where("d = 1")
    n = F.row_number().over(Window.partitionBy("qid", "kind").orderBy("priority", "doc_id"))
    w = Window.partitionBy("qid").orderBy(F.col("n") > 1, "priority", "doc_id")
    return once.withColumn("n", n).withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= limit).select("qid", "doc_id", "kind", "pick")


def spread_sample(rows: DataFrame, by: str, n: int, seed: str = "seed") -> DataFrame:
    """Exactly n rows (or all), at least one of each group where n allows: one each, the rest by largest remainder of the share."""
    c = rows.groupBy(by).agg(F.count("*").alias("c"))
    t = c.agg(F.sum("c").alias("t"), F.count("*").alias("g"))
    s = c.crossJoin(F.broadcast(t)).withColumn("exact", F.greatest(F.lit(0), F.least(F.lit(n), F.col("t")) - F.col("g")) * (F.col("c") - 1) / F.greatest(F.col("t") - F.col("g"), F.lit(1)))
    s = s.withColumn("base", F.floor("exact"))
    w = Window.orderBy(F.desc(F.col("exact") - F.col("base")), by)  # one row a group
    rest = F.greatest(F.lit(0), F.least(F.lit(n), F.col("t")) - F.col("g")) - F.sum("base").over(Window.partitionBy())
    s = s.withColumn("quota", 1 + F.col("base") + (F.row_number().over(w) <= rest).cast("int"))
    return first_by_hash(rows, by, s.select(by, "quota"), seed=seed)


def similar_questions(questions: DataFrame, threshold: float) -> DataFrame:
    """(a, b, likeness) of questions (qid, text), a before b, whose token sets are alike by strictly more than ``threshold``; see ``set_join``."""
    t = questions.select(F.col("qid").alias("id"), F.array_distinct(tokens(F.col("text"))).alias("s"))
    return set_join(t, None, threshold).select("a", "b", F.round("likeness", 6).alias("likeness"))


def missing_kinds(rows: DataFrame, key: str, kind: str, required: list[str]) -> DataFrame:
    """(key, missing) of keys that lack required kinds, sorted and comma-joined."""
    have = rows.groupBy(key).agg(*[F.bool_or(F.col(kind) == r).alias(f"k{i}") for i, r in enumerate(required)])
    gone = F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(F.col(f"k{i}"), F.lit(False)), r) for i, r in enumerate(required)])))
    return have.select(key, F.array_join(gone, ",").alias("missing")).where("missing <> ''")


def result_hash(rows: DataFrame) -> DataFrame:
    """(rows, digest): an order-free digest of all rows, to compare two runs."""
    h = F.xxhash64(*[F.col(c) for c in rows.columns]).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("rows"), F.sum(h).cast("string").alias("digest"))


def refresh_deadline(outcome: Column, at: Column) -> Column:
    """When to look again: a day after an incomplete outcome, a week after pending material, a month after success."""
    days = F.when(outcome == "success", 30).when(outcome == "pending", 7).otherwise(1)
    return at + F.make_dt_interval(days)


def dangling_references(references: DataFrame, docs: DataFrame) -> DataFrame:
    """(ref, citing): referenced ids (doc_id, ref) that no document has, with the number of documents that refer to them."""
    r = references.where("ref is not null").groupBy("ref").agg(F.count_distinct("doc_id").alias("citing"))
    return r.join(docs.select(F.col("doc_id").alias("__doc")), F.col("ref") == F.col("__doc"), "left_anti")


def reconcile_flags(items: DataFrame, ledger: DataFrame, key: str, positive) -> DataFrame:
    """``items`` with ``flag``: true if any of the key's ledger rows is positive, false if none is, unlisted without a row."""
    ever = ledger.groupBy(F.col(key).alias("__k")).agg(F.bool_or(F.coalesce(positive, F.lit(False))).alias("__ever"))
    flag = F.when(F.col("__ever").isNull(), "unlisted").when(F.col("__ever"), "true").otherwise("false")
    return items.join(ever, F.col(key) == F.col("__k"), "left").withColumn("flag", flag).drop("__k", "__ever")
