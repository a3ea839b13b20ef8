"""Runs of crawls and ingestion: verdicts, completion rules, quarantine ledgers, schema baselines, shards and cursors, progress, text filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.operators.governance import codes, violations
from quarry.session import materialize

ISSUES = 32  # issues that a verdict lists


def crawl_verdict(counters: DataFrame, runs: DataFrame, reconcilers: DataFrame) -> DataFrame:
    """(run, passed, issues) from counters (run, key, value), runs (run, expected, finish_reason, spider_errors, item_errors) and reconcilers (run,
    scope, finalized, ok).

    ``spider_exceptions/count`` stands for all exceptions where it is given, else the others of that prefix are added up. Of the issues
    the first ``ISSUES`` are listed.
    """
    total = F.col("key") == "spider_exceptions/count"
    c = counters.groupBy("run").agg(
        F.sum(F.when(F.col("key") == "quality/failures", F.col("value"))).alias("failures"),
        F.coalesce(F.sum(F.when(total, F.col("value"))), F.sum(F.when(F.col("key").startswith("spider_exceptions/"), F.col("value")))).alias("exceptions"),
    )
    t = reconcilers.groupBy("run").agg(F.count("*").alias("n"), F.count_if("finalized").alias("done"), F.count_if(F.col("finalized") & ~F.coalesce("ok", F.lit(False))).alias("bad"))
    j = runs.join(c, "run", "left").join(t, "run", "left")
    checks = {
        "finish_reason": ~F.col("finish_reason").eqNullSafe(F.col("expected")),
        "reconciliation_failed": F.col("bad") > 0,
        "not_finalized": F.col("done") < F.col("n"),
        "quality_failures": F.col("failures") > 0,
        "spider_errors": F.col("spider_errors") > 0,
        "exceptions": F.col("exceptions") > 0,
        "item_errors": F.col("item_errors") > 0,
    }
    issues = codes(checks)
    return j.select("run", (F.size(issues) == 0).alias("passed"), F.slice(issues, 1, ISSUES).alias("issues"))


def completion_rules(records: DataFrame, now: Column) -> DataFrame:
    """(run, code) of completion records (run, started, finished, items, counted, failures, paginators, reconciled) that break the contract."""
    checks = {
        "times_out_of_order": ~F.coalesce(F.col("started") <= F.col("finished"), F.lit(False)),
        "in_the_future": F.col("finished") > now,
        "failures": F.col("failures") > 0,
        "not_reconciled": F.col("reconciled") != F.col("paginators"),
        "item_count": F.col("items") != F.col("counted"),
    }
    return violations(records, ["run"], checks)


def quarantine_check(ledger: DataFrame, excluded: DataFrame, key: list[str]) -> DataFrame:
    """(key, code): keys listed twice in a quarantine ledger, and those that only one of ledger and excluded set has. Nulls are equal."""
    a, b = ledger.groupBy(*key).agg(F.count("*").alias("n")), excluded.select(*key).distinct()
    twice = a.where("n > 1").select(*key, F.lit("listed_twice").alias("code"))
    lost = a.select(*key).exceptAll(b).withColumn("code", F.lit("not_excluded"))
    extra = b.exceptAll(a.select(*key)).withColumn("code", F.lit("not_listed"))
    return twice.unionByName(lost).unionByName(extra)


def schema_news(items: DataFrame, baseline: DataFrame | None = None, declared: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(news, baseline after) of items (source, at, keys).

    The baseline (source, key) is kept between batches. A source without one takes the keys of its first item, without
    an alert. News (source, key, items, declared): keys that the baseline lacks, and in how many items they came.
    """
    k = items.select("source", "at", F.explode(F.array_distinct("keys")).alias("key"))
    first = items.groupBy("source").agg(F.min("at").alias("at"))
    if baseline is not None:
        first = first.join(baseline.select("source").distinct(), "source", "left_anti")
    seed = k.join(first, ["source", "at"]).select("source", "key").distinct()
    known = seed if baseline is None else baseline.select("source", "key").unionByName(seed)
    n = k.join(known, ["source", "key"], "left_anti").groupBy("source", "key").agg(F.count("*").alias("items"))
    n = n.withColumn("declared", F.col("key").isin(declared or []))
    return n, known.unionByName(n.select("source", "key"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``index``, gapless from 0 in the order of ``order``: counts of ranges added up, no single sorted task."""
    # written once, because a range partitioning that is computed twice may be cut elsewhere
    r = materialize(rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "numbered")
    r = r.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1)
    before = r.groupBy("__p").agg(F.count("*").alias("n"))
    before = before.select(F.col("__p").alias("__q"), F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return r.join(F.broadcast(before), F.col("__p") == F.col("__q")).withColumn("index", F.col("__i") + F.col("__b")).drop("__p", "__q", "__b", "__i")  # a row a range


def pending_of_shards(rows: DataFrame, cursors: DataFrame, shards: int) -> DataFrame:
    """What is left after cursors (shard, cursor): rows (index, ...) with ``shard`` = index mod ``shards`` and ``done``, whether the shard's cursor claims it."""
    r = rows.withColumn("shard", F.pmod("index", F.lit(shards)).cast("int"))
    c = cursors.groupBy(F.col("shard").alias("__s")).agg(F.max("cursor").alias("__c"))
    return r.join(F.broadcast(c), F.col("shard") == F.col("__s"), "left").withColumn("done", F.coalesce(F.col("index") <= F.col("__c"), F.lit(False))).drop("__s", "__c")  # a row a shard


def claims_check(claimed: DataFrame, acknowledged: DataFrame, key: str) -> DataFrame:
    """(key, code): rows that cursors claim (key, hash, chunks) but that the store lacks, or holds with another hash or count."""
    a = acknowledged.select(F.col(key).alias("__k"), F.col("hash").alias("__h"), F.col("chunks").alias("__n"))
    j = claimed.join(a, F.col(key) == F.col("__k"), "left")
    return violations(j, [key], {"not_acknowledged": F.col("__k").isNull(), "hash_differs": F.col("__h") != F.col("hash"), "count_differs": F.col("__n") != F.col("chunks")})


def progress(batches: DataFrame, by: str) -> DataFrame:
    """Running totals of batches (by, at, n, failed): done, failures and rows a minute since the first; null in the first minute's first batch."""
    w = Window.partitionBy(by).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    minutes = (F.unix_micros(F.col("at").cast("timestamp")) - F.unix_micros(F.min("at").over(w).cast("timestamp"))) / 60e6
    return batches.select(by, "at", F.sum("n").over(w).alias("done"), F.sum("failed").over(w).alias("failures"), F.round(F.try_divide(F.sum("n").over(w), minutes), 4).alias("per_minute"))


def reason_pivot(rows: DataFrame, reasons: list[str], by: str = "source", reason: str = "reason") -> DataFrame:
    """Counts of each reason by source, and over all sources (null)."""
    return rows.rollup(by).agg(*[F.count_if(F.col(reason) == r).alias(r) for r in reasons], F.count("*").alias("total"))


def text_matches(queries: DataFrame, docs: DataFrame, shortest: int = 2, longest: int = 30) -> DataFrame:
    """(qid, doc_id): documents that hold every word of a query; words outside the lengths do not count, and a query without words matches nothing.

    A join on single words with counts: each document's different words are met once.
    """
    fit = lambda d, i, t: d.select(F.col(i), F.explode(F.array_distinct(F.filter(tokens(F.col(t)), lambda w: F.length(w).between(shortest, longest)))).alias("w"))
    q = fit(queries, "qid", "text")
    n = q.groupBy("qid").agg(F.count("*").alias("n"))
    words = q.select("w").distinct()
    d = fit(docs, "doc_id", "text").join(words, "w", "left_semi")
    hit = d.join(q, "w").groupBy("qid", "doc_id").agg(F.count("*").alias("got"))
    return hit.join(n, "qid").where("got = n").select("qid", "doc_id")


def documents_only(chunks: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row a document: the first chunk, under any condition."""
    first = chunks.where(F.col("chunk_index") == 0)
    return first if condition is None else first.where(condition)


def snapshot_rows(rows: DataFrame, source: str, ids: DataFrame | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of ``source``, others): a snapshot's rows (source, doc_id, ...), those of given ids alone, the first ``limit`` by id; and the rows
    that claim another source than the file's, which make a strict reader refuse it."""
    good = rows.where(F.col("source") == source)
    if ids is not None:
        good = good.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    if limit is not None:
        good = good.orderBy("doc_id").limit(limit)
    return good, rows.where(~F.col("source").eqNullSafe(F.lit(source)))
