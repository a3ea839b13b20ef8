"""Agreement and leakage: panels, paired comparisons, questions against an earlier pool, negatives without leaks, conflicting chunks, staged seen-sets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import damage, tokens
from quarry.operators.setjoin import set_join
from quarry.sinks.files import NameTaken
from quarry.streaming.ingest import Pointers, merge_seen

DEPTH = 12


def panel_rates(panel: DataFrame, by: str, axes: list[str]) -> DataFrame:
    """Rates of merged verdicts (by, abstained, axes): answers, abstentions and, of the answers only, the share that each axis holds of; null without answers."""
    said = ~F.col("abstained")
    rate = lambda a: F.round(F.try_divide(F.count_if(said & F.col(a)), F.count_if(said)), 6).alias(a)
    return panel.groupBy(by).agg(F.count("*").alias("items"), F.count_if(said).alias("answered"), *[rate(a) for a in axes])


def paired(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """(metric, query, cluster, a, b) of two runs (metric, query, cluster, value); a query that only one of them has, or in another cluster, fails the job."""
    other = b.select(F.col("metric").alias("__m"), F.col("query").alias("__q"), F.col("cluster").alias("__c"), F.col(value).alias("__v"))
    j = a.join(other, (F.col("metric") == F.col("__m")) & (F.col("query") == F.col("__q")), "full_outer")
    wrong = F.col("query").isNull() | F.col("__q").isNull() | ~F.col("cluster").eqNullSafe(F.col("__c"))
    said = F.raise_error(F.concat(F.lit("runs do not pair at query "), F.coalesce("query", "__q").cast("string"))).cast("double")
    return j.select("metric", "query", "cluster", F.when(wrong, said).otherwise(F.col(value)).alias("a"), F.col("__v").alias("b"))


def verdicts(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``tests`` (name, delta, lo, hi, adjusted) with ``verdict``: better or worse where the interval leaves out 0 and the adjusted p is below ``alpha``, else tie."""
    sure = (F.col("adjusted") < alpha) & ((F.col("lo") > 0) | (F.col("hi") < 0))
    return tests.withColumn("verdict", F.when(sure & (F.col("delta") > 0), "better").when(sure & (F.col("delta") < 0), "worse").otherwise("tie"))


def near_pool(batch: DataFrame, pool: DataFrame, threshold: float) -> DataFrame:
    """(qid, pool_id, likeness): questions of a batch whose token sets are alike by more than ``threshold`` to one of an earlier pool (both qid, text); see ``set_join``."""
    sets = [d.select(F.col("qid").alias("id"), F.array_distinct(tokens(F.col("text"))).alias("s")) for d in (batch, pool)]
    return set_join(*sets, threshold).select(F.col("a").alias("qid"), F.col("b").alias("pool_id"), F.round("likeness", 6).alias("likeness"))


def paraphrase_lint(pairs: DataFrame, most: float = 0.5) -> DataFrame:
    """(qid, likeness, copied) of questions beside their evidence (qid, text, evidence): the share of the question's tokens that the evidence has, and whether it is above ``most``."""
    q, e = F.array_distinct(tokens(F.col("text"))), tokens(F.col("evidence"))
    share = F.try_divide(F.size(F.array_intersect(q, e)), F.size(q))
    return pairs.select("qid", F.round(share, 6).alias("likeness"), F.coalesce(share > most, F.lit(False)).alias("copied"))


def without_leaks(candidates: DataFrame, gold: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates (qid, doc_id, hash, family) that leak nothing: not of the gold text or family of their question (gold: qid, hash, family), nor of a held-out document."""
    g = gold.select(F.col("qid").alias("__q"), F.col("hash").alias("__h"), F.col("family").alias("__f"))
    same = (F.col("qid") == F.col("__q")) & ((F.col("hash") == F.col("__h")) | (F.col("family") == F.col("__f")))
    return candidates.join(g, same, "left_anti").join(held.select("doc_id").distinct(), "doc_id", "left_anti")


def document_conflicts(chunks: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row a document: the value of each field that its first chunk has, and ``conflicts``: the fields on which its chunks differ (a null is a value)."""
    first = [F.min_by(f, F.struct("chunk_index", *fields)).alias(f) for f in fields]
    kinds = [(F.count_distinct(f) + F.max(F.col(f).isNull().cast("int"))).alias(f"__{f}") for f in fields]
    g = chunks.groupBy(key).agg(F.count("*").alias("chunks"), *first, *kinds)
    return g.select(key, "chunks", *fields, F.array_compact(F.array(*[F.when(F.col(f"__{f}") > 1, f) for f in fields])).alias("conflicts"))


def family_ids(components: DataFrame, source: Column) -> DataFrame:
    """Components (node, component) with ``family``: an id from the source and the least member, which stays while that member does."""
    return components.withColumn("family", F.substring(F.sha2(F.concat_ws(":", source, F.col("component").cast("string")), 256), 1, 16))


def repeated_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """(line, repeated): JSON objects whose top level names a key more than once, which a strict reader refuses.

    Parsers keep one of the repeats and say nothing, so keys are read from the text, without what is nested, down to ``DEPTH`` levels.
    """
    flat = F.regexp_replace(F.col(column), r"\\.", "")
    flat = F.regexp_replace(flat, r'"([^"]*)"\s*:', "\x01$1\x02")  # keys out of the way of other strings
    flat = F.regexp_replace(flat, r'"[^"]*"', "0")
    for _ in range(DEPTH):  # innermost values first
        flat = F.regexp_replace(flat, "(?<=[\\[:,\x02])\\s*[\\[{][^\\[\\]{}]*[\\]}]", "0")
    keys = F.regexp_extract_all(flat, F.lit("\x01([^\x01\x02]*)\x02"), F.lit(1))
    twice = F.array_distinct(F.filter(keys, lambda k: F.size(F.filter(keys, lambda o: o == k)) > 1))
    return lines.select(F.col(column).alias("line"), F.array_sort(twice).alias("repeated")).where(F.size("repeated") > 0)


def index_reason(body: Column, complete: Column, status: Column) -> Column:
    """Why a document is not indexed: damage to its body first, then what its extraction says; null if it is fit."""
    said = F.lower(F.trim(status))
    return F.coalesce(damage(body)["reason"], F.when(~F.coalesce(complete, F.lit(False)), "incomplete_content").when(said.isin("scanned_no_text", "malformed", "truncated", "resource_limited"), F.concat(F.lit("extraction_"), said)))


def topic_windows(windows: DataFrame, topics: DataFrame) -> DataFrame:
    """Every window for every topic of its scope: windows (scope, from, to) and topics (scope, topic), joined on the scope; a scope without topics keeps a null one."""
    t = topics.select(F.col("scope").alias("__s"), "topic").distinct()
    return windows.join(t, F.col("scope") == F.col("__s"), "left").drop("__s")


class SeenStore:
    """What has been seen (key, outcome, last_success, content_hash, at), in two phases: a run's rows are staged, then committed or rolled back as a whole.

    Staged rows are read by nobody. A commit is one renamed pointer that names the run's folder among the deltas, so it writes nothing else
    and a crash leaves the run staged; a reader merges base and deltas in one aggregation. With ``MOST`` deltas a commit also writes a new
    base. Repeating a stage or a commit changes nothing; a committed run is not rolled back.
    """

    SCHEMA = "key long, outcome string, last_success long, content_hash string, at long"
    MOST = 16

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.pointers = spark, root.rstrip("/"), Pointers(spark, root)

    def _folders(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.root}/{n}" for n in names]) if names else self.spark.createDataFrame([], self.SCHEMA)

    def _merged(self, p: dict) -> DataFrame:
        return merge_seen(self._folders([p["base"]] if p.get("base") else []), self._folders(p.get("deltas", [])))

    def read(self) -> DataFrame:
        return self._merged(self.pointers.current())

    def stage(self, run: str, rows: DataFrame) -> None:
        if run not in self.pointers.current().get("runs", []):
            rows.write.mode("overwrite").parquet(f"{self.root}/staged/{run}")

    def commit(self, run: str, tries: int = 5) -> None:
        """Make a staged run visible. A run committed by another writer meanwhile stays: the pointer is made again on top of it, ``tries`` times at most."""
        for left in reversed(range(tries)):
            p = self.pointers.current()
            if run in p.get("runs", []):
                return
            new = {"runs": p.get("runs", []) + [run], "base": p.get("base"), "deltas": p.get("deltas", []) + [f"staged/{run}"]}
            if len(new["deltas"]) >= self.MOST:
                base = f"base-{p['batch'] + 1}-{uuid.uuid4().hex}"
                self._merged(new).write.parquet(f"{self.root}/{base}")
                new |= {"base": base, "deltas": []}
            try:
                return self.pointers.put(p["batch"] + 1, new)
            except NameTaken:
                if not left:
                    raise

    def rollback(self, run: str) -> None:
        if run in self.pointers.current().get("runs", []):
            raise ValueError(f"{run} is committed")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/staged/{run}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
