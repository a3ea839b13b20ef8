"""Evaluation of rankings, answers and judges: joins, windows and conditional aggregates; statistics of runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.selection import kth_values
from quarry.session import materialize

Z95 = 1.6448536269514722  # one-sided 95 % normal quantile


def reduce_ranking(hits: DataFrame, key: str) -> DataFrame:
    """(qid, key, rank): first occurrence of each key, ranks made dense again."""
    first = hits.groupBy("qid", key).agg(F.min("rank").alias("at"))
    return first.select("qid", key, F.row_number().over(Window.partitionBy("qid").orderBy("at", key)).alias("rank"))


def ranking_scores(ranking: DataFrame, qrels: DataFrame, queries: DataFrame, k: int = 10, successes: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Per query: success at each depth, MRR@k and nDCG@k with gain 2^grade - 1.

    ``qrels`` (qid, doc_id, grade). A query without hits or without relevant documents scores 0 and stays.
    """
    gain = F.pow(F.lit(2.0), "grade") - 1
    hit = ranking.join(qrels.where("grade > 0"), ["qid", "doc_id"])
    dcg = F.sum(F.when(F.col("rank") <= k, gain / F.log2(F.col("rank") + 1.0)))
    per = hit.groupBy("qid").agg(F.min("rank").alias("first"), dcg.alias("dcg"))
    w = Window.partitionBy("qid").orderBy(F.desc("grade"), "doc_id")
    ideal = qrels.where("grade > 0").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("qid").agg(F.sum(gain / F.log2(F.col("r") + 1.0)).alias("ideal"))
    out = queries.select("qid").join(per, "qid", "left").join(ideal, "qid", "left")
    return out.select(
        "qid",
        *[F.coalesce((F.col("first") <= n).cast("int"), F.lit(0)).alias(f"success_{n}") for n in successes],
        F.round(F.when(F.col("first") <= k, 1.0 / F.col("first")).otherwise(0.0), 6).alias("mrr"),
        F.round(F.least(F.lit(1.0), F.coalesce(F.col("dcg") / F.col("ideal"), F.lit(0.0))), 6).alias("ndcg"),
    )


def group_scores(ranking: DataFrame, groups: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Evidence groups (qid, group_id, doc_id, grade; doc_id null: a group nothing can satisfy).

    Per query: recall of groups in the first k, and nDCG in which a hit earns the gain of the groups it is the first to satisfy.
    """
    size = groups.groupBy("qid").agg(F.count_distinct("group_id").alias("groups"))
    best = groups.groupBy("qid", "group_id").agg(F.max("grade").alias("grade"))
    first = groups.join(ranking.where(F.col("rank") <= k), ["qid", "doc_id"]).groupBy("qid", "group_id").agg(F.min(F.struct("rank", -F.col("grade"))).alias("m"))
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    per = first.groupBy("qid").agg(F.count("*").alias("met"), F.sum(gain(-F.col("m")["col2"]) / F.log2(F.col("m.rank") + 1.0)).alias("dcg"))
    w = Window.partitionBy("qid").orderBy(F.desc("grade"), "group_id")
    ideal = best.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("qid").agg(F.sum(gain(F.col("grade")) / F.log2(F.col("r") + 1.0)).alias("ideal"))
    out = queries.select("qid").join(size, "qid", "left").join(per, "qid", "left").join(ideal, "qid", "left")
    return out.select("qid", F.coalesce("groups", F.lit(0)).alias("groups"), F.round(F.coalesce(F.coalesce("met", F.lit(0)) / F.col("groups"), F.lit(0.0)), 6).alias("group_recall"), F.round(F.least(F.lit(1.0), F.coalesce(F.col("dcg") / F.col("ideal"), F.lit(0.0))), 6).alias("group_ndcg"))


def context_quality(hits: DataFrame, groups: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Per query over the first k hits: the share that repeats (a seen key, or only groups met before) and the share that meets no
    group. No hits: (0, 1)."""
    h = hits.where(F.col("rank") <= k).select("qid", "rank", "doc_id")
    seen = F.row_number().over(Window.partitionBy("qid", "doc_id").orderBy("rank")) > 1
    g = groups.where("doc_id is not null").select("qid", "doc_id", "group_id").distinct()
    m = h.join(g, ["qid", "doc_id"], "left")
    met_before = F.min("rank").over(Window.partitionBy("qid", "group_id")) < F.col("rank")
    m = m.withColumn("old", F.when(F.col("group_id").isNotNull(), met_before))
    per_hit = m.groupBy("qid", "rank", "doc_id").agg(F.count("group_id").alias("n"), F.coalesce(F.bool_and("old"), F.lit(False)).alias("all_old"))
    per_hit = per_hit.withColumn("dup", seen | ((F.col("n") > 0) & F.col("all_old")))
    out = per_hit.groupBy("qid").agg(F.round(F.avg(F.col("dup").cast("double")), 6).alias("duplication"), F.round(F.avg((F.col("n") == 0).cast("double")), 6).alias("noise"))
    return queries.select("qid").join(out, "qid", "left").select("qid", F.coalesce("duplication", F.lit(0.0)).alias("duplication"), F.coalesce("noise", F.lit(1.0)).alias("noise"))


def answer_margin(hits: DataFrame) -> DataFrame:
    """Per query: first document, its best score and its lead over the second document; alone, its own score."""
    d = hits.groupBy("qid", "doc_id").agg(F.max("score").alias("score"), F.min("rank").alias("at"))
    r = d.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("at", "doc_id"))).where("r <= 2")
    out = r.groupBy("qid").agg(F.max(F.when(F.col("r") == 1, F.col("doc_id"))).alias("top_doc"), F.max(F.when(F.col("r") == 1, F.col("score"))).alias("top_score"), F.max(F.when(F.col("r") == 2, F.col("score"))).alias("second"))
    return out.select("qid", "top_doc", "top_score", F.round(F.col("top_score") - F.coalesce("second", F.lit(0.0)), 6).alias("margin"))


def metric_table(scores: DataFrame, metrics: list[str], by: str) -> DataFrame:
    """Mean and count of the non-null values of each metric, by group and over all (group null), in one pass."""
    aggs = [x for m in metrics for x in (F.round(F.coalesce(F.avg(m), F.lit(0.0)), 6).alias(m), F.count(m).alias(f"n_{m}"))]
    return scores.rollup(by).agg(*aggs)


def percentiles(rows: DataFrame, value: str, by: str) -> DataFrame:
    """Interpolated p50 and p95, and the value of ceiling rank at 95 %, of the non-null values of each group; null where it has none.

    The ranks of all groups are searched at once (``selection.kth_values``), so a group of any size is no single task.
    """
    n = rows.groupBy(by).agg(F.count(value).alias("n"))
    at = lambda p: p * (F.col("n") - 1)
    wanted = [F.floor(at(0.5)), F.ceil(at(0.5)), F.floor(at(0.95)), F.ceil(at(0.95)), F.ceil(0.95 * F.col("n") - 1e-9) - 1]
    n = materialize(n, "sizes")
    ranks = n.where("n > 0").select(by, F.posexplode(F.array(*[w.cast("long") for w in wanted])).alias("slot", "rank"))
    found = kth_values(rows, [by], value, ranks).groupBy(F.col(by).alias("__by")).agg(*[F.max(F.when(F.col("slot") == i, F.col("value"))).alias(f"v{i}") for i in range(len(wanted))])
    j = n.join(found, F.col(by).eqNullSafe(F.col("__by")), "left")
    between = lambda p, lo, hi: F.round(F.col(lo) + (at(p) - F.floor(at(p))) * (F.col(hi) - F.col(lo)), 6)
    return j.select(by, between(0.5, "v0", "v1").alias("p50"), between(0.95, "v2", "v3").alias("p95"), F.col("v4").alias("p95_disc"))


def rank_percentile(rows: DataFrame, value: str, by: str, p: float, how: str) -> DataFrame:
    """The value at index floor(p / 100 * n) ("truncate", at most n - 1) or at the banker's rounding of p / 100 * (n - 1) ("round") of each group's n non-null values."""
    n = F.col("n")
    i = F.least(n - 1, F.floor(p / 100 * n)) if how == "truncate" else F.bround(p / 100 * (n - 1))
    ranks = rows.groupBy(by).agg(F.count(value).alias("n")).where("n > 0").select(by, F.lit(0).alias("slot"), i.alias("rank"))
    return kth_values(rows, [by], value, ranks).select(by, "value")


def abstention(rows: DataFrame, threshold: float) -> DataFrame:
    """(answerable, score) -> retention, correct and false refusals and false accepts at a threshold."""
    ok = F.col("answerable")
    share = lambda c, of: F.round(F.coalesce(F.avg(F.when(of, c.cast("double"))), F.lit(0.0)), 6)
    above = F.col("score") >= threshold
    return rows.agg(share(above, ok).alias("retention"), share(~above, ~ok).alias("correct_refusal"), share(~above, ok).alias("false_refusal"), share(above, ~ok).alias("false_accept"))


def panel_majority(votes: DataFrame, key: str, axes: list[str]) -> DataFrame:
    """Strict majority per axis: a tie is false."""
    return votes.groupBy(key).agg(F.count("*").alias("judges"), *[(F.sum(F.col(a).cast("int")) * 2 > F.count("*")).alias(a) for a in axes])


def wilson(successes: Column, total: Column, upper: bool = True) -> Column:
    """One-sided 95 % Wilson bound; no trials: 1 above, 0 below."""
    n, p = total.cast("double"), successes / total
    spread = Z95 * F.sqrt(p * (1 - p) / n + Z95**2 / (4 * n * n))
    centre = p + Z95**2 / (2 * n)
    edge = (centre + spread if upper else centre - spread) / (1 + Z95**2 / n)
    return F.when(total == 0, 1.0 if upper else 0.0).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), edge)), 8))


def holm(tests: DataFrame, p: str = "p") -> DataFrame:
    """Step-down adjusted p-values: the running greatest of (m - i) * p in ascending order, at most 1. Tests are few."""
    w = Window.orderBy(p, "name")
    m = tests.withColumn("r", F.row_number().over(w)).crossJoin(F.broadcast(tests.agg(F.count("*").alias("m"))))
    adjusted = F.least(F.lit(1.0), F.max((F.col("m") - F.col("r") + 1) * F.col(p)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return m.select("name", p, F.round(adjusted, 8).alias("adjusted"))


#: Cumulative Poisson(1) probabilities: a replicate draws a cluster as often as its uniform number passes them.
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(13)]
PER_DIGEST = 4  # uniform numbers of 32 bits from one MD5


def _digest(seed: int, block: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(seed)), block.cast("string"), F.coalesce(F.col("cluster").cast("string"), F.lit(""))).cast("binary"))


def bootstrap_ci(scores: DataFrame, resamples: int = 10_000, alpha: float = 0.05, seed: int = 12345) -> DataFrame:
    """(metric, query, cluster, value) -> mean and percentile interval of the cluster bootstrap of the ratio mean.

    Replicates are rows: each cluster counts in each of them as often as a Poisson(1) draw says, which a hash of seed, replicate
    and cluster decides, so a rerun agrees and SQL can say the same. One aggregation sums clusters by (metric, replicate) with
    partial sums a task; no group is gathered, and only ``resamples`` means a metric meet at the end. A replicate that draws no
    cluster at all has no mean and is left out.
    """
    by = scores.where("value is not null").groupBy("metric", "cluster").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    by = materialize(by, "clusters")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(-(-resamples // PER_DIGEST) - 1))).alias("block")
    d = by.select("metric", "s", "n", "cluster", blocks).withColumn("h", _digest(seed, F.col("block")))
    u = lambda i: (F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    cdf = F.array(*[F.lit(x) for x in POISSON])
    r = d.select("metric", "s", "n", "block", F.posexplode(F.array(*[u(i) for i in range(PER_DIGEST)])).alias("i", "u"))
    r = r.select("metric", "s", "n", (F.col("block") * PER_DIGEST + F.col("i")).alias("b"), F.size(F.filter(cdf, lambda x: x <= F.col("u"))).alias("k")).where(F.col("b") < resamples)
    means = r.groupBy("metric", "b").agg((F.sum(F.col("k") * F.col("s")) / F.nullif(F.sum(F.col("k") * F.col("n")), F.lit(0))).alias("m"))
    ends = means.groupBy("metric").agg(F.percentile("m", alpha / 2).alias("lo"), F.percentile("m", 1 - alpha / 2).alias("hi"))
    whole = by.groupBy("metric").agg((F.sum("s") / F.sum("n")).alias("mean"), F.count("*").alias("clusters"))
    return whole.join(ends.withColumnRenamed("metric", "__m"), F.col("metric").eqNullSafe(F.col("__m"))).select("metric", "mean", "lo", "hi", "clusters")


def permutation_p(pairs: DataFrame, resamples: int = 10_000, seed: int = 12345) -> DataFrame:
    """(metric, cluster, a, b) -> difference of means and the cluster sign-flip p-value (#at least as large + 1) / (B + 1); no difference: 1.

    Flips are rows like the bootstrap's replicates: a cluster's sign in flip b is a bit of a hash, 128 of them an MD5.
    """
    ok = pairs.where("a is not null and b is not null")
    by = materialize(ok.groupBy("metric", "cluster").agg(F.sum(F.col("a") - F.col("b")).alias("d"), F.count("*").alias("n")), "clusters")
    d = by.select("metric", "d", "cluster", F.explode(F.sequence(F.lit(0), F.lit(-(-resamples // 128) - 1))).alias("block")).withColumn("h", _digest(seed, F.col("block")))
    r = d.select("metric", "d", "block", "h", F.explode(F.sequence(F.lit(0), F.lit(127))).alias("i")).withColumn("b", F.col("block") * 128 + F.col("i")).where(F.col("b") < resamples)
    digit = F.conv(F.expr("substring(h, cast(i div 4 as int) + 1, 1)"), 16, 10).cast("int")
    r = r.withColumn("up", F.floor(digit / F.pow(F.lit(2.0), F.col("i") % 4)) % 2 == 1)
    sums = r.groupBy("metric", "b").agg(F.sum(F.when(F.col("up"), F.col("d")).otherwise(-F.col("d"))).alias("x"))
    seen = by.groupBy("metric").agg(F.sum("d").alias("sum"), F.sum("n").alias("n")).withColumnRenamed("metric", "__m")
    j = sums.join(seen, F.col("metric").eqNullSafe(F.col("__m"))).where(F.abs("sum") > 1e-12)
    more = j.groupBy(F.col("__m").alias("__q")).agg(F.count_if(F.abs(F.col("x") / F.col("n")) >= F.abs(F.col("sum") / F.col("n")) - 1e-12).alias("more"))
    out = seen.join(more, F.col("__m").eqNullSafe(F.col("__q")), "left")
    return out.select(F.col("__m").alias("metric"), (F.col("sum") / F.col("n")).alias("diff"), F.coalesce((F.col("more") + 1) / (resamples + 1), F.lit(1.0)).alias("p"))


def risk_band(scores: DataFrame, bands: DataFrame) -> DataFrame:
    """Each score with the half-open band [lo, hi) that has it; bands (lo, hi, band, errors, total) are few and broadcast."""
    j = scores.join(F.broadcast(bands), (F.col("score") >= F.col("lo")) & (F.col("score") < F.col("hi")), "left")
    return j.select(*scores.columns, "band", wilson(F.col("errors"), F.col("total")).alias("error_limit"))


def overlap_join(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """Spans (doc_id, span_id, s, e) with the chunks (doc_id, chunk_index, cs, ce) they overlap, half-open; an empty span meets
    the chunk that holds or touches it. An equi join on the document with a range condition."""
    hit = ((F.col("s") < F.col("ce")) & (F.col("cs") < F.col("e"))) | ((F.col("s") == F.col("e")) & (F.col("cs") <= F.col("s")) & (F.col("s") <= F.col("ce")))
    return spans.join(chunks, "doc_id").where(hit)
