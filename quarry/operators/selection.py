"""Order statistics and prefix sums of many groups at once, without sorting a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import broadcast_if_small, materialize, release

BUCKETS = 4_096  # parts into which one round cuts the interval of a group
LAST = 10_000  # rows of an interval that one task may sort


def null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Condition that all ``keys`` of two frames agree, null with null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys], F.lit(True))


def find_cuts(rows: DataFrame, by: list[str], key: str, weight: str | None, goals: DataFrame, tie: str | None = None) -> DataFrame:
    """Per row of ``goals``, where the running weight of its group, in order of ``key`` and ``tie``, first passes the goal.

    ``goals`` has the columns ``by``, ``slot`` (several goals of one group) and ``goal``; ``weight`` None counts rows. Returns
    ``by``, ``slot``, ``everything`` (the whole group stays within the goal), ``cut_key`` and ``cut_tie`` (the last row within
    it; not ``reached``: only rows below ``cut_key``), ``next_key`` (the key that passes it) and ``taken`` (weight within it).
    Rows with a null or NaN key count for nothing, null weights as 0; groups without such rows have no result.

    Each round cuts the open interval of every large group into ``BUCKETS`` equal parts, sums them by partial aggregation and
    goes on with the part that holds the passing row; an interval of ``LAST`` rows is sorted. A group is thus never sorted,
    gathered or windowed whole, however many rows it has. Equal keys beyond ``LAST`` rows are narrowed by ``tie`` likewise.
    """
    ids = [*by, "slot"]
    r = rows.select(*by, F.col(key).alias("__k"), (F.col(tie) if tie else F.lit(None).cast("long")).alias("__t"), F.coalesce(F.col(weight), F.lit(0)).alias("__w") if weight else F.lit(1).cast("long").alias("__w"))
    r = r.where(F.col("__k").isNotNull() & ~F.isnan(F.col("__k").cast("double")))
    first = r.groupBy(*by).agg(F.min("__k").alias("__lo"), F.max("__k").alias("__hi"), F.count("*").alias("__n"), F.sum("__w").alias("__all"))
    g = goals.select(*by, "slot", "goal")
    state = materialize(first.join(g, null_safe(first, g, by)).select(*[first[b] for b in by], "slot", "goal", "__lo", "__hi", "__n", "__all", F.lit(0).cast(first.schema["__all"].dataType).alias("__below")), "cuts")
    groups, whole = state.count(), first.schema["__lo"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    fits = F.col("__all") <= F.col("goal")
    large = ~fits & (F.col("__n") > LAST)

    def of(live: DataFrame) -> DataFrame:
        x = live.select(*[F.col(b).alias(f"__b{i}") for i, b in enumerate(by)], "slot", "goal", "__lo", "__hi", "__below")
        same = reduce(lambda p, q: p & q, [r[b].eqNullSafe(x[f"__b{i}"]) for i, b in enumerate(by)], F.lit(True))
        return r.join(broadcast_if_small(x, groups), same & (F.col("__k") >= F.col("__lo")) & (F.col("__k") <= F.col("__hi"))).drop(*[f"__b{i}" for i in range(len(by))])

    while not state.where(large & (F.col("__lo") < F.col("__hi"))).isEmpty():
        live = state.where(large & (F.col("__lo") < F.col("__hi")))
        # whole numbers are subtracted exactly; halves, so that the difference of two doubles cannot pass their range
        x = (lambda c: F.col(c).cast("decimal(38,0)")) if whole else (lambda c: F.col(c) / 2)
        at = F.try_divide((x("__k") - x("__lo")).cast("double"), (x("__hi") - x("__lo")).cast("double"))
        part = F.coalesce(F.least(F.floor(at * BUCKETS), F.lit(BUCKETS - 1)), (F.col("__k") > F.col("__lo")).cast("long"))
        sums = of(live).groupBy(*ids, "goal", "__below", part.alias("__b")).agg(F.sum("__w").alias("__w"), F.count("*").alias("__n"), F.min("__k").alias("__lo"), F.max("__k").alias("__hi"))
        cum = F.sum("__w").over(Window.partitionBy(*ids).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0))
        over = sums.withColumn("__cum", cum).where(F.col("__below") + F.col("__cum") > F.col("goal"))
        pick = over.groupBy(*ids, "goal").agg(F.min_by(F.struct("__lo", "__hi", "__n", (F.col("__below") + F.col("__cum") - F.col("__w")).alias("__below"), F.lit(None).cast(first.schema["__all"].dataType).alias("__all")), "__b").alias("x"))
        done = state.where(~F.coalesce(large & (F.col("__lo") < F.col("__hi")), F.lit(False)))
        fresh = pick.select(*ids, "goal", "x.*").withColumn("__all", F.col("goal") + 1).withColumn("__all", F.col("__all").cast(first.schema["__all"].dataType))
        new = materialize(done.unionByName(fresh), "cuts")
        release(state)
        state = new
    ties = state.where(large & (F.col("__lo") == F.col("__hi"))) if tie else None
    if tie and not ties.isEmpty():  # many equal keys: the same search by their tie
        inner = find_cuts(of(ties).select(*by, "slot", "__t", "__w").withColumnRenamed("slot", "__s"), [*by, "__s"], "__t", "__w", ties.select(*by, F.col("slot").alias("__s"), F.lit(0).alias("slot"), (F.col("goal") - F.col("__below")).alias("goal")))
        back = inner.select(*by, F.col("__s").alias("slot"), F.when(F.col("reached"), F.col("cut_key")).otherwise(F.col("cut_key") - 1).alias("__cut"), F.col("taken").alias("__got"))
        x = ties.alias("x")
        tied = x.join(back, null_safe(x, back, ids)).select(*[x[c] for c in ids], F.lit(False).alias("everything"), F.col("__lo").alias("cut_key"), F.col("__cut").alias("cut_tie"), F.col("__lo").alias("next_key"), (F.col("__below") + F.col("__got")).alias("taken"), F.lit(True).alias("reached"))
    short = state.where(~fits & (F.col("__n") <= LAST)) if tie else state.where(~fits & ((F.col("__n") <= LAST) | (F.col("__lo") == F.col("__hi"))))
    flat = short.where(F.col("__lo") == F.col("__hi")) if not tie else None
    if flat is not None:
        short = short.where(F.col("__lo") < F.col("__hi"))
    cum = F.col("__below") + F.sum("__w").over(Window.partitionBy(*ids).orderBy("__k", "__t").rowsBetween(Window.unboundedPreceding, 0))
    run = of(short).withColumn("__cum", cum)
    within = F.col("__cum") <= F.col("goal")
    last = run.groupBy(*ids).agg(
        F.max(F.when(within, F.struct("__k", "__t", F.col("__cum").alias("c")))).alias("x"), F.min(F.when(~within, F.col("__k"))).alias("next_key"), F.min("__lo").alias("__lo"), F.min("__below").alias("__below")
    )
    out = last.select(*ids, F.lit(False).alias("everything"), F.coalesce("x.__k", "__lo").alias("cut_key"), F.col("x.__t").alias("cut_tie"), "next_key", F.coalesce("x.c", "__below").alias("taken"), F.col("x").isNotNull().alias("reached"))
    none = F.lit(None).cast("long")
    out = out.unionByName(state.where(fits).select(*ids, F.lit(True).alias("everything"), F.col("__hi").alias("cut_key"), none.alias("cut_tie"), F.lit(None).cast(first.schema["__lo"].dataType).alias("next_key"), F.col("__all").alias("taken"), F.lit(True).alias("reached")))
    if flat is not None:
        out = out.unionByName(flat.select(*ids, F.lit(False).alias("everything"), F.col("__lo").alias("cut_key"), none.alias("cut_tie"), F.col("__lo").alias("next_key"), F.col("__below").alias("taken"), F.lit(False).alias("reached")))
    elif not ties.isEmpty():
        out = out.unionByName(tied)
    return out


def within_cut(key: Column, tie: Column) -> Column:
    """Whether a row joined to its cut lies within the goal."""
    return F.coalesce((F.col("everything") & key.isNotNull()) | (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (tie <= F.col("cut_tie"))), F.lit(False))


def kth_values(rows: DataFrame, by: list[str], value: str, ranks: DataFrame) -> DataFrame:
    """(by, slot, value): the value of each group at the 0-based ``rank`` of ``ranks`` (by, slot, rank) among its non-null values in order. Groups are narrowed as in ``find_cuts``."""
    goals = ranks.select(*by, "slot", F.col("rank").cast("long").alias("goal"))
    return find_cuts(rows, by, value, None, goals).where(~F.col("everything")).select(*by, "slot", F.col("next_key").alias("value"))


def first_by_hash(rows: DataFrame, by: str, quotas: DataFrame, key: str = "doc_id", seed: str = "seed") -> DataFrame:
    """The first ``quota`` rows of each group of ``quotas`` (by, quota), in order of the SHA-256 of seed and ``key`` (its first 60 bits), then of ``key``, a whole number.

    What a group's last row may have is searched, so no group is sorted in one task. Groups without a quota have no rows.
    """
    order = F.conv(F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 15), 16, 10).cast("long")
    held = materialize(rows.withColumn("__key", order).withColumn("__tie", F.coalesce(F.col(key).cast("long"), F.lit(0))), "held")
    cuts = find_cuts(held, [by], "__key", None, quotas.select(by, F.lit(0).alias("slot"), F.col("quota").alias("goal")), "__tie")
    c = materialize(cuts.withColumnRenamed(by, "__by"), "cuts")
    near = held.join(broadcast_if_small(c, c.count()), F.col(by).eqNullSafe(F.col("__by")))
    return near.where(within_cut(F.col("__key"), F.col("__tie"))).select(*rows.columns)
