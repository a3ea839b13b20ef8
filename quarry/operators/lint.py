"""Data-set and run validation: windows that must join up, reviewers who must agree, sets that must be equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.governance import violations


def contiguous_windows(windows: DataFrame, by: str) -> DataFrame:
    """(by, start, code) of date windows (by, start, end) that end before they start, overlap or leave a gap, in order of start."""
    w = Window.partitionBy(by).orderBy("start", "end")
    j = windows.withColumn("__p", F.lag("end").over(w))
    checks = {"reversed": F.col("end") < F.col("start"), "overlap": F.col("start") <= F.col("__p"), "gap": F.col("start") > F.date_add("__p", 1)}
    return violations(j, [by, "start"], checks)


def final_reviews(reviews: DataFrame) -> DataFrame:
    """(item, verdict, how) from (item, reviewer, role, verdict): two agreeing reviewers, else the adjudicator, else unresolved (null)."""
    g = reviews.groupBy("item").agg(
        F.count_distinct(F.when(F.col("role") == "reviewer", F.col("reviewer"))).alias("n"),
        F.min(F.when(F.col("role") == "reviewer", F.col("verdict"))).alias("lo"),
        F.max(F.when(F.col("role") == "reviewer", F.col("verdict"))).alias("hi"),
        F.max(F.when(F.col("role") == "adjudicator", F.col("verdict"))).alias("adj"),
    )
    agree = (F.col("n") >= 2) & (F.col("lo") == F.col("hi"))
    return g.select("item", F.when(agree, F.col("lo")).otherwise(F.col("adj")).alias("verdict"), F.when(agree, "agreed").when(F.col("adj").isNotNull(), "adjudicated").otherwise("unresolved").alias("how"))


def set_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of either side, with repeats, that the other lacks: (columns, side)."""
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def issue_report(issues: DataFrame, by: str, key: str, examples: int = 3) -> DataFrame:
    """(by, total, example, n): the count of each code beside its first examples. The limit is pushed below the shuffle; counts are partial sums."""
    first = issues.select(by, key).withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy(key))).where(F.col("n") <= examples)
    totals = issues.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("total"))
    return first.join(totals, F.col(by).eqNullSafe(F.col("__by"))).select(by, "total", F.col(key).alias("example"), "n")


def exactly_one(flags: list[Column]) -> Column:
    """Exactly one of the conditions holds."""
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0)) == 1


def expand_references(hits: DataFrame, references: DataFrame, chunks: DataFrame, top: int = 3) -> DataFrame:
    """(qid, doc_id, chunk_index): chunks of the same document whose article the first ``top`` hits refer to, less the hits themselves."""
    first = hits.where(F.col("rank") <= top).select("qid", "doc_id", "chunk_index")
    want = first.join(references, ["doc_id", "chunk_index"]).select("qid", "doc_id", "article").distinct()
    found = want.join(chunks, ["doc_id", "article"]).select("qid", "doc_id", "chunk_index").distinct()
    return found.join(hits.select("qid", "doc_id", "chunk_index"), ["qid", "doc_id", "chunk_index"], "left_anti")


def rollout(events: DataFrame) -> DataFrame:
    """(candidate, stage) after events (candidate, at, event): shadow, five_percent, production or rolled_back.

    Each promotion takes one step; any breach is final. The stage is the number of promotions, which a breach overrides.
    """
    g = events.groupBy("candidate").agg(F.count_if(F.col("event") == "promote").alias("p"), F.bool_or(F.col("event") == "breach").alias("b"))
    return g.select("candidate", F.when(F.col("b"), "rolled_back").when(F.col("p") == 0, "shadow").when(F.col("p") == 1, "five_percent").otherwise("production").alias("stage"))


def joint_report(audits: dict[str, DataFrame]) -> DataFrame:
    """(audit, code, n): findings of several audits (each with a column code) by code; an audit without findings is one row, ok, without a count."""
    spark = next(iter(audits.values())).sparkSession
    rows = reduce(DataFrame.unionByName, [a.select(F.lit(name).alias("audit"), "code") for name, a in audits.items()])
    names = spark.createDataFrame([(n,) for n in audits], "audit string")
    counts = rows.groupBy("audit", "code").agg(F.count("*").alias("n"))
    return names.join(counts, "audit", "left").select("audit", F.coalesce("code", F.lit("ok")).alias("code"), "n")
