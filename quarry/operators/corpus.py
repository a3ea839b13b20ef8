"""Corpus curation: quarantine, exact and near duplicates, profiles, schema drift and version selection."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import content_hash, damage
from quarry.operators.components import connected_components
from quarry.session import broadcast_if_small, materialize

SUSPECT = 40  # members beyond which a key is more likely a placeholder than a duplicate
BLOCK = 192  # classes of a region in one block
BUCKET = 1_024  # classes of a bucket in one block, compared by signature
HOT_ROWS = 1_000_000  # rows of a key that one task may sort
TASK_ROWS = 20_000  # rows of small buckets that one task compares
MARGIN = 5  # standard deviations of an estimated likeness


def hygiene_report(docs: DataFrame) -> DataFrame:
    """doc_id and what ``damage`` says of each body."""
    return docs.select("doc_id", damage(F.col("text")).alias("d")).select("doc_id", "d.*")


def split_quarantine(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined with reason)."""
    all_ = docs.withColumn("reason", damage(F.col("text"))["reason"])
    return all_.where("reason is null").drop("reason"), all_.where("reason is not null")


def key_clusters(rows: DataFrame, key: str) -> DataFrame:
    """(cluster_key, size, representative, suspect) of keys that more than one doc_id has; null and empty keys are none."""
    k = rows.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("cluster_key"))
    out = k.agg(F.count("*").alias("size"), F.min("doc_id").alias("representative")).where("size > 1")
    return out.withColumn("suspect", F.col("size") > SUSPECT)


def cluster_stats(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.count("*").alias("clusters"), F.coalesce(F.sum("size"), F.lit(0)).alias("docs"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"), F.count_if("suspect").alias("suspects"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, cluster_key, representative) of documents whose bodies are equal to another's. One row a member: no lists."""
    h = docs.select("doc_id", content_hash(F.col("text")).alias("h"))
    c = key_clusters(h, "h")
    return h.join(c, h.h == c.cluster_key).select("doc_id", "cluster_key", "representative")


def band_keys(docs: DataFrame, permutations: int = 128, rows_per_band: int = 4, width: int = 5) -> DataFrame:
    """(doc_id, source, set, bands): distinct shingle hashes, ascending, and the keys of the MinHash bands, in Arrow batches.

    Shingles are runs of ``width`` white-space words; shorter texts are one shingle and blank ones have no row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rnd = np.random.default_rng(17)
    mult = rnd.integers(1, 2**63, permutations, dtype=np.uint64) | np.uint64(1)
    place = rnd.integers(1, 2**63, permutations, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, sets, bands, signatures = [], [], [], []
            for i, t in enumerate(b.column(2)):
                words = (t.as_py() or "").split()
                if not words:
                    continue
                k = min(width, len(words))
                grams = {" ".join(words[j : j + k]) for j in range(len(words) - k + 1)}
                s = np.sort(np.fromiter((xxhash.xxh3_64_intdigest(g.encode()) for g in grams), np.uint64, len(grams)))
                least = np.full(permutations, 2**64 - 1, np.uint64)
                for at in range(0, len(s), 512):
                    np.minimum(least, (s[at : at + 512, None] * mult[None, :]).min(axis=0), out=least)
                keys = (least * place).reshape(-1, rows_per_band).sum(axis=1, dtype=np.uint64)
                who.append(i)
                sets.append(s.view(np.int64))
                bands.append(keys.view(np.int64))
                signatures.append((least >> np.uint64(48)).astype(np.uint16).tobytes())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(who, pa.int64())) for c in (0, 1)), pa.array(sets, longs), pa.array(bands, longs), pa.array(signatures, pa.binary())], ["doc_id", "source", "set", "bands", "signature"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, f"doc_id {kind}, source string, set array<long>, bands array<long>, signature binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of the sets of ``left`` with those of ``right``, by 0/1 matrices of 4096 shared members at a time."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (x, xo), (y, yo) = flat(left), flat(right)
    both = np.intersect1d(x, y)
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(both), 4096):
        part = both[at : at + 4096]
        m = []
        for v, o, n in ((x, xo, len(left)), (y, yo, len(right))):
            i = np.minimum(np.searchsorted(part, v), len(part) - 1)
            hit = part[i] == v
            m.append(np.zeros((n, len(part)), np.float32))
            m[-1][o[hit], i[hit]] = 1
        out += (m[0] @ m[1].T).astype(np.int64)
    return out


def _confirmed(ids: list, sets: list[np.ndarray], blocks: list[int], threshold: Fraction) -> list[tuple]:
    """Links of two blocks (or of one with itself) that connect all linked sets, and no more than that takes."""
    blk = np.array(blocks)
    left, right = np.flatnonzero(blk == blk.min()), np.flatnonzero(blk == blk.max())
    inter = _overlaps([sets[i] for i in left], [sets[i] for i in right])
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[right][None, :] - inter
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(threshold.denominator * inter >= threshold.numerator * union), strict=True):
        p, q = find(x := int(left[i])), find(y := int(right[j]))
        if p != q:
            parent[p] = q
            out.append((ids[x], ids[y]))
    return out


def confirmed_links(reps: DataFrame, regions: DataFrame, threshold: float) -> DataFrame:
    """(rep, other): links between all classes (rep, set) of each region (node, component), confirmed on full sets.

    A region is cut into blocks of about ``BLOCK`` classes and each pair of blocks is one small task, so every pair of classes
    of a region is compared once, whatever its size.
    """
    kind, exact = dict(reps.dtypes)["rep"], Fraction(str(threshold))
    nb = F.ceil(F.col("count") / BLOCK).cast("int")
    nodes = regions.join(regions.groupBy("component").count(), "component").select("node", "component", nb.alias("nb"), F.pmod(F.xxhash64("node"), nb).cast("int").alias("blk"))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("blk", j).alias("i"), F.greatest("blk", j).alias("j")))
    rows = reps.join(broadcast_if_small(nodes, regions.count()), F.col("rep") == F.col("node")).select("rep", "component", "blk", "set", F.explode(pair).alias("at"))

    def compare(t: pa.Table) -> pa.Table:
        ids, sets = t.column("rep").to_pylist(), [np.asarray(x.values) for x in t.column("set")]
        got = _confirmed(ids, sets, t.column("blk").to_pylist(), exact) if len(ids) > 1 else []
        return pa.table({n: pa.array([g[i] for g in got], t.schema.field("rep").type) for i, n in enumerate(("rep", "other"))})

    return rows.groupBy("component", "at").applyInArrow(compare, f"rep {kind}, other {kind}")


def likely_links(keys: DataFrame, signatures: DataFrame, threshold: float, permutations: int) -> DataFrame:
    """(rep, other) that connect the classes of each bucket (source, band, h, rep) whose signatures (rep, signature) agree nearly as often as ``threshold`` says.

    Buckets with the same members count once. A bucket is cut into blocks of ``BUCKET`` classes and each pair of blocks is compared,
    many small ones in a task. A pair is let go only where its agreement lies ``MARGIN`` standard deviations below the threshold,
    less often than once in a million pairs at it.
    """
    kind = dict(keys.dtypes)["rep"]
    least = threshold - MARGIN * (threshold * (1 - threshold) / permutations) ** 0.5
    members = keys.groupBy("source", "band", "h").agg(F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who")).where("n > 1")
    once = members.groupBy("source", "n", "who").agg(F.min(F.struct("band", "h")).alias("b")).select("source", "b.*", "n")
    nb = F.ceil(F.col("n") / BUCKET).cast("int")
    own = keys.join(once, ["source", "band", "h"]).withColumn("bucket", F.xxhash64("source", "band", "h")).withColumn("nb", nb).withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("blk", j).alias("i"), F.greatest("blk", j).alias("j")))
    rows = own.select("bucket", "rep", "blk", F.explode(pair).alias("at")).join(signatures, "rep")
    tasks = max(1, -(-keys.count() // TASK_ROWS))

    def compare(t: pa.Table) -> pa.Table:
        d = t.to_pandas()
        a, b = [], []
        for _, g in d.groupby(["bucket", "i", "j"], sort=False):
            if len(g) < 2:
                continue
            sig, ids, blk = np.stack([np.frombuffer(x, np.uint16) for x in g["signature"]]), g["rep"].to_numpy(), g["blk"].to_numpy()
            left, right = np.flatnonzero(blk == blk.min()), np.flatnonzero(blk == blk.max())
            parent = list(range(len(ids)))

            def find(x: int, parent: list[int] = parent) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for x in left:
                for y in right[(sig[right] == sig[x]).mean(1) >= least]:
                    if (p := find(x)) != (q := find(y)):  # links that connect, and no more
                        parent[p] = q
                        a.append(ids[x])
                        b.append(ids[y])
        return pa.table({"rep": pa.array(a, t.schema.field("rep").type), "other": pa.array(b, t.schema.field("rep").type)})

    return rows.select("bucket", "rep", "blk", "at.*", "signature").groupBy(F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(tasks))).applyInArrow(compare, f"rep {kind}, other {kind}")


def near_duplicate_clusters(docs: DataFrame, threshold: float = 0.85, permutations: int = 128, rows_per_band: int = 4) -> DataFrame:
    """(doc_id, component) of documents linked, within one source, by a shingle likeness of ``threshold`` or more.

    Equal sets are one class before banding. Classes that share a MinHash band are compared by their signatures first, so that
    common boilerplate links nothing; what is likely then makes regions, and all pairs of a region are confirmed on full sets.
    A region of m different sets costs m^2 / ``BLOCK`` copies of a set. A document without words is in no cluster.
    """
    d = materialize(band_keys(docs, permutations, rows_per_band).withColumn("key", F.sha2(F.concat_ws(",", F.col("set").cast("array<string>")), 256)), "sets")
    cls = materialize(d.groupBy("source", "key").agg(F.min("doc_id").alias("rep")), "classes")
    reps = d.join(cls, ["source", "key"]).where("doc_id = rep").select("source", "rep", "set", "bands", "signature")
    keys = materialize(reps.select("source", "rep", F.posexplode("bands").alias("band", "h")), "bands")
    met = materialize(likely_links(keys, reps.select("rep", "signature"), threshold, permutations), "likely")
    regions = materialize(connected_components(met, "rep", "other"), "regions")
    links = materialize(confirmed_links(reps.select("rep", "set"), regions, threshold), "links")
    same = d.join(cls, ["source", "key"]).where("doc_id <> rep").select("rep", F.col("doc_id").alias("other"))
    return connected_components(links.union(same), "rep", "other").select(F.col("node").alias("doc_id"), "component")


def profile(docs: DataFrame) -> DataFrame:
    """Per source: rows, distinct bodies, clean rows, rows by quarantine reason and damage kinds, sizes."""
    d = docs.select("source", "text", damage(F.col("text")).alias("d"))
    reasons = ["empty_body", "near_empty", "mojibake"]
    return d.groupBy("source").agg(
        F.count("*").alias("raw"),
        F.count_distinct(content_hash(F.col("text"))).alias("unique_bodies"),
        F.count_if(F.col("d.reason").isNull()).alias("clean"),
        *[F.count_if(F.col("d.reason") == r).alias(r) for r in reasons],
        F.count_if(F.col("d.nul_chars") > 0).alias("nul_docs"),
        F.count_if(F.col("d.control_chars") > 0).alias("control_docs"),
        F.sum("d.raw_length").alias("chars"),
    )


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the given order (the greatest), ties by the other columns. A partial aggregate: a hot key is no single task."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in rows.columns])


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Idempotent upsert: rows of ``new`` replace those of ``old`` with the same key, null with null. Of repeated new keys the greatest row stays."""
    last = latest_per_key(new, key, [])
    named = last.select(*[F.col(k).alias(f"__k_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in key])
    return old.join(named, same, "left_anti").unionByName(last)


def drop_stale_tail(chunks: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """Chunks whose index is below their document's new count (the least of several, null keys with null); documents without a count keep all."""
    c = counts.groupBy(*[F.col(k).alias(f"__k_{k}") for k in key]).agg(F.min("chunk_count").alias("__n"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in key])
    return chunks.join(c, same, "left").where(F.col("__n").isNull() | (F.col("chunk_index") < F.col("__n"))).select(*chunks.columns)


def schema_drift(rows: DataFrame, json: str, baseline: list[str], declared: list[str]) -> DataFrame:
    """(key, rows, declared) of JSON keys that the baseline lacks."""
    keys = rows.select(F.explode(F.json_object_keys(F.col(json))).alias("key")).groupBy("key").agg(F.count("*").alias("rows"))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return keys.where(~F.array_contains(lit(baseline), F.col("key"))).withColumn("declared", F.array_contains(lit(declared), F.col("key")))


def versions_as_of(versions: DataFrame, as_of) -> DataFrame:
    """The version of each document in force at ``as_of``: [effective_from, effective_to), null ends open.

    A document with two versions in force at once is ambiguous and flagged rather than guessed at.
    """
    live = versions.where((F.col("effective_from") <= as_of) & (F.col("effective_to").isNull() | (F.col("effective_to") > as_of)))
    g = live.groupBy("document_id").agg(F.count_distinct("version_id").alias("versions"), F.min("version_id").alias("version_id"), F.min("effective_from").alias("effective_from"))
    return g.select("document_id", F.when(F.col("versions") == 1, F.col("version_id")).alias("version_id"), (F.col("versions") > 1).alias("ambiguous"), F.when(F.col("versions") == 1, F.col("effective_from")).alias("effective_from"))


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, value: str, parts: int = 64) -> DataFrame:
    """Each left row with the last right value at or before its time, of the same key; of equal times the greatest value. A null key meets nothing.

    Within a key a window finds the last value. Where a key has more than ``HOT_ROWS`` rows, time is cut at ``parts`` approximate
    quantiles, so a hot key is many groups and none of them is one task's whole key; a left row before the first value of its group
    takes the last of the key's earlier groups, which are at most ``parts`` a key.
    """
    both = left.select(key, time, F.lit(1).alias("__l"), F.lit(None).alias("__v"), F.struct(*left.columns).alias("__r")).unionByName(
        right.where(F.col(value).isNotNull()).select(key, time, F.lit(0).alias("__l"), F.col(value).alias("__v"), F.lit(None).alias("__r"))
    )
    most = left.select(key).unionByName(right.select(key)).groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= HOT_ROWS:
        w = Window.partitionBy(key).orderBy(time, "__l", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__l = 1")
        return own.select("__r.*", F.when(F.col(key).isNotNull(), F.col("__v")).alias(f"asof_{value}"))
    edges = right.agg(F.percentile_approx(time, [i / parts for i in range(1, parts)]).alias("e")).first().e or []  # ``parts`` values
    part = F.lit(0)
    for i, e in enumerate(sorted(set(edges))):
        part = F.when(F.col(time) >= F.lit(e).cast(dict(right.dtypes)[time]), i + 1).otherwise(part)
    both = both.withColumn("__p", part)
    w = Window.partitionBy(key, "__p").orderBy(time, "__l", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__l = 1")
    ends = both.where("__l = 0").groupBy(F.col(key).alias("__k"), F.col("__p").alias("__q")).agg(F.max(F.struct(time, "__v"))["__v"].alias("__last"))
    groups = both.select(F.col(key).alias("__k"), F.col("__p").alias("__q")).distinct().join(ends, ["__k", "__q"], "left")
    before = F.last("__last", ignorenulls=True).over(Window.partitionBy("__k").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("__k", "__q", before.alias("__before")).where("__before is not null")
    j = own.join(groups, (F.col(key) == F.col("__k")) & (F.col("__p") == F.col("__q")), "left")
    return j.select("__r.*", F.when(F.col(key).isNotNull(), F.coalesce("__v", "__before")).alias(f"asof_{value}"))
