"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.selection import find_cuts, within_cut
from quarry.session import broadcast_if_small, materialize

#: Documents after the cut, in rank order, that may fill what the sample still lacks.
RESERVE = 1_000
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Runs of other than the six ASCII white-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> with ``place`` (int), ``source_weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn and share ``share`` of all sizes; no target passes
    ``most`` times its source's size: what is above goes to the others by weight, until none is above. One row a source is
    ordered in one task. Sizes of 0 have target 0. ``share`` may not pass ``most``.
    """
    if share > most or min(weights) <= 0:
        raise ValueError("share may not pass most, weights must be positive")
    one = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("place", (F.row_number().over(one) - 1).cast("int")).withColumn("source_weight", w).withColumn("__cap", F.col("source_size") * float(most))
    # level by level: a source is full if the level that the others would have without it still fills it
    up = Window.orderBy(F.col("__cap") / F.col("source_weight"), "place")
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("__level", (F.sum("source_size").over(every) * float(share) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("source_weight").over(after))
    level = F.min(F.when(F.col("__level") * F.col("source_weight") <= F.col("__cap"), F.struct(F.col("__cap") / F.col("source_weight"), "place", F.col("__level").alias("v")))).over(every)
    s = s.withColumn("__at", level["v"])
    return s.select("source", "source_size", "place", "source_weight", F.least("__cap", F.coalesce(F.col("__at") * F.col("source_weight"), F.col("__cap"))).alias("target"))


def uniform(seed: str, *keys: Column | str) -> Column:
    """A number inside (0, 1) that the keys alone decide: 52 bits of an MD5."""
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _rates(rows: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """Adds ``rate`` to (place, size, weight): copies expected of each, ``most`` at most, proportional to its weight else.

    Per source the factor is found by fixing what is above ``most`` and sharing the rest anew until nothing is above.
    """
    n, level = sources.count(), sources.select("place", "target", F.lit(0.0).alias("factor"), F.lit(0).cast("long").alias("full"))
    while True:
        full = F.col("factor") * F.col("weight") >= most
        x = rows.join(broadcast_if_small(level.select("place", "target", "factor"), n), "place")
        sums = x.groupBy("place", "target", "factor").agg(F.sum(F.when(full, F.col("size")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("weight") * F.col("size"))).alias("open"))
        factor = F.coalesce(F.try_divide(F.col("target") - F.col("full") * most, "open"), "factor")
        new = materialize(sums.select("place", "target", factor.alias("factor"), "full"), "factors")
        if new.alias("a").join(level.alias("b"), "place").where("a.full <> b.full").isEmpty():
            return rows.join(broadcast_if_small(new.select("place", "factor"), n), "place").withColumn("rate", F.least(F.lit(float(most)), F.col("factor") * F.col("weight"))).drop("factor")
        level = new


def mix_sources(df: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", weight: str | None = None, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """Every row of ``df`` with its place in a mix: ``key``, ``size``, ``source_size``, ``target`` (its source's), ``copies`` (int) and ``taken`` (copies x size).

    A row's rate (copies expected) is its source's target over its source's size, or proportional to ``weight`` within the
    source, ``most`` at most. The whole part of a rate is allocated to all; the rest is the inclusion probability p of a
    Pareto sample: rows are ranked by their random odds u / (1 - u) over their inclusion odds p / (1 - p), and the sample, of
    fixed size in the unit of ``size``, is the longest run of ranks that stays within what the target lacks; of the next
    ``RESERVE`` rows, in rank order, each that still fits is added. So a source misses its target by less than the least of
    those rows, and never passes it. u depends on ``key`` and ``seed`` alone: reruns agree.

    The cut of all sources is found by ``selection.find_cuts``, so no source is sorted in one task. Null sources are a source
    of their own, null or negative sizes count 0, null or negative weights too (a source without any weight takes nothing),
    repeated rows are ranked by their place in the input, an empty table gives an empty result. Other columns are left out.
    """
    clean = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    own = F.greatest(F.coalesce(F.col(weight), F.lit(0)), F.lit(0)).cast("double") if weight else F.lit(1.0)
    rows = materialize(df.select(F.col(key).alias("key"), F.col(source).alias("source"), clean.alias("size"), own.alias("weight"), F.monotonically_increasing_id().alias("row")), "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(source_targets(sizes, weights, share, most), "targets")
    n = sources.count()
    placed = rows.join(broadcast_if_small(sources, n), rows["source"].eqNullSafe(sources["source"])).drop("source")
    if weight:
        rated = _rates(placed.drop("target", "source_size", "source_weight"), sources, most)
        rated = rated.join(broadcast_if_small(sources.select("place", "source_size", "target"), n), "place")
    else:
        rated = placed.withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    p = F.col("rate") - F.floor("rate")
    u = uniform(seed, "key")
    rank = F.when((p > 0) & (F.col("size") > 0), u / (1 - u) * ((1 - p) / p))
    # rows of one key are ranked by size, then by their place in the input
    rated = materialize(rated.select("key", "size", "source_size", "target", "place", F.floor("rate").cast("int").alias("whole"), rank.alias("rank"), "row"), "mix")
    goals = rated.groupBy("place", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("sure")).select("place", F.lit(0).alias("slot"), (F.col("target") - F.col("sure")).alias("goal"), "target")
    goals = materialize(goals, "goals")
    cuts = materialize(find_cuts(rated, ["place"], "rank", "size", goals, "row"), "cuts")
    cut = broadcast_if_small(cuts.join(goals.select("place", "goal"), "place").withColumn("lack", F.col("goal") - F.col("taken")), n)
    chosen = rated.join(cut, "place", "left").withColumn("first", within_cut(F.col("rank"), F.col("row")))
    # what follows the cut and would fit: the first RESERVE of it, by the same search
    left = chosen.where(F.col("rank").isNotNull() & ~F.col("first") & (F.col("size") <= F.col("lack"))).select("place", "rank", "row", "size", "lack")
    left = materialize(left, "reserve")
    per = left.groupBy("place").agg(F.first("lack").alias("lack")).select("place", F.lit(0).alias("slot"), F.lit(RESERVE).alias("goal"))
    edge = find_cuts(left, ["place"], "rank", None, per, "row")
    near = left.join(broadcast_if_small(edge, n), "place").where(within_cut(F.col("rank"), F.col("row")))
    walk = F.aggregate(
        F.col("r"),
        F.struct(F.col("lack").alias("lack"), F.array().cast("array<bigint>").alias("got")),
        lambda a, x: F.when(x["size"] <= a["lack"], F.struct((a["lack"] - x["size"]).alias("lack"), F.array_append(a["got"], x["row"]).alias("got"))).otherwise(a),
    )
    fill = near.groupBy("place", "lack").agg(F.array_sort(F.collect_list(F.struct("rank", "row", "size"))).alias("r")).select(F.explode(walk["got"]).alias("row"))  # RESERVE rows a source at most
    fill = materialize(fill.withColumn("filled", F.lit(True)), "fill")
    out = chosen.join(broadcast_if_small(fill, fill.count()), "row", "left")
    copies = F.col("whole") + (F.col("first") | F.coalesce("filled", F.lit(False))).cast("int")
    return out.select(F.col("key").alias(key), F.col("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
