"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item's sketch is its bottom-k MinHash: the k least hash values among its distinct shingles. Items are partitioned by
size, each size on its own: k depends on it, and a document meets only the sizes it can hold. k is chosen so that a document holding the wanted share of the shingles must hold ``hits`` of any k of
them (it lacks ``floor((1 - t) * n)`` at most). The search is therefore complete, not only likely so.
Documents are read once for the search; only candidates are read again, and each is confirmed on shingle strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import broadcast_if_small, materialize

WIDTH = 5
PERCENT = 80
SPARE = 2  # hits wanted beyond the one that is certain, where the item is long enough

#: Bytes of all items' shingles up to which they are broadcast to the confirmation.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of the runs of ``width`` words, in order; none if there are fewer words."""
    one = lambda i: F.xxhash64(F.lit(width), *[F.element_at(words, i + F.lit(j)) for j in range(width)])
    return F.when(F.size(words) >= width, F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), one)).otherwise(F.array().cast("array<bigint>"))


def shingle_texts(words: Column, width: int) -> Column:
    """Distinct runs of ``width`` words as strings."""
    texts = F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) >= width, F.array_distinct(texts)).otherwise(F.array().cast("array<string>"))


def sketches(items: DataFrame, percent: int = PERCENT, width: int = WIDTH, spare: int = SPARE) -> tuple[DataFrame, DataFrame]:
    """(items with their shingles, sketch rows). Items shorter than ``width`` words are one shingle of all their words."""
    it = items.select("item_id", "text").distinct().withColumn("w", words_of(F.col("text"))).where(F.size("w") > 0)
    it = it.withColumn("width", F.least(F.size("w"), F.lit(width)))
    texts, hashes = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    for k in range(1, width + 1):
        texts = F.when(F.col("width") == k, shingle_texts(F.col("w"), k)).otherwise(texts)
        hashes = F.when(F.col("width") == k, F.array_distinct(shingle_hashes(F.col("w"), k))).otherwise(hashes)
    it = it.select("item_id", F.md5("text").alias("item_key"), "width", texts.alias("item_shingles"), hashes.alias("h")).withColumn("n", F.size("item_shingles"))
    lacks = F.floor(F.col("n") * (100 - percent) / 100).cast("int")
    it = it.withColumn("k", F.least(F.col("n"), lacks + 1 + spare)).withColumn("hits", F.col("k") - lacks)
    sk = it.select("item_id", "item_key", "n", "hits", F.explode(F.slice(F.array_sort("h"), F.lit(1), F.col("k"))).alias("hash"))
    return it.drop("h", "k", "hits"), sk


def find_contamination(docs: DataFrame, items: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, n_shingles, shared, containment) for every document that holds ``percent`` of an item's shingles.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Null or empty texts hold
    nothing and are held by nothing. Rows that share a doc_id (null included) or an item_id count as one, with the
    largest containment of any of their rows. Empty tables give an empty result. Sketches are broadcast only when
    their counted rows are within the limit, the items' shingles when their measured bytes are; beyond it the same plan shuffles.
    """
    known, sk = sketches(items, percent, width)
    known, sk = materialize(known, "items"), materialize(sk, "sketch")
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # at most ``width`` numbers
    src = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    hashes = F.concat(*[shingle_hashes(F.col("w"), k) for k in widths]) if widths else F.array().cast("array<bigint>")
    seen = src.select("doc_id", F.size("w").alias("n_words"), F.explode(hashes).alias("hash"))
    sk = broadcast_if_small(sk, sk.count())
    # size partition: a document with fewer shingles than the wanted share cannot hold the item
    fits = (F.col("n_words") * 100 >= F.col("n") * percent)
    hit = seen.join(sk, "hash").where(fits).groupBy("doc_id", "item_id", "item_key", "hits", "hash").agg(F.lit(1).alias("one"))
    found = hit.groupBy("doc_id", "item_id", "item_key", "hits").agg(F.count("*").alias("got")).where("got >= hits")
    found = materialize(found.select("doc_id", "item_id", "item_key"), "candidates")
    n = found.count()
    ids = found.select(F.col("doc_id").alias("__id")).distinct()
    near = docs.select("doc_id", "text").join(broadcast_if_small(ids, n), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    near = near.withColumn("w", words_of(F.col("text"))).select(F.col("doc_id").alias("__id"), *[shingle_texts(F.col("w"), k).alias(f"s{k}") for k in widths])
    size = known.agg(F.sum(F.aggregate("item_shingles", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 16))).first()[0] or 0
    known = F.broadcast(known) if size <= BROADCAST_BYTES else known
    pairs = broadcast_if_small(found, n).join(near, F.col("doc_id").eqNullSafe(F.col("__id"))).join(known, ["item_id", "item_key"])
    held = F.lit(0)
    for k in widths:
        held = F.when(F.col("width") == k, F.size(F.array_intersect("item_shingles", f"s{k}"))).otherwise(held)
    pairs = pairs.select("doc_id", "item_id", F.col("n").cast("long").alias("n_shingles"), held.cast("long").alias("shared")).where(F.col("shared") * 100 >= F.col("n_shingles") * percent)
    w = Window.partitionBy("doc_id", "item_id").orderBy(F.desc(F.col("shared") / F.col("n_shingles")), F.desc("n_shingles"))
    best = pairs.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    return best.withColumn("containment", F.col("shared") / F.col("n_shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that ``find_contamination`` reports; all columns and other rows stay."""
    bad = materialize(find_contamination(docs, items, percent, width).select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    return docs.join(broadcast_if_small(bad, bad.count()), F.col("doc_id").eqNullSafe(F.col("__bad")), "left_anti")
