"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

RING_BITS = 14  # 16,384 ring slots
VNODES = 1_024  # virtual nodes a shard
RUN = 100_000  # equal rows that one task deals out


def virtual_nodes(shards: int, vnodes: int = VNODES, bits: int = RING_BITS) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node, clockwise. A shard's nodes do not depend on how many shards there are."""
    at = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> (64 - bits)
    return sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))


def place(counts: dict[int, int], shards: int, vnodes: int = VNODES, bits: int = RING_BITS) -> list[tuple[int, int, int, int, int]]:
    """Walk the ring once, clockwise, and give runs (slot, from, to, shard, first place in the shard).

    A slot's keys go to the first virtual node at or after it whose shard has room; those that overflow a full
    shard continue clockwise to the next. Capacities differ by one at most, so loads do too.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    ring = virtual_nodes(shards, vnodes, bits)
    runs, i = [], 0
    for slot in sorted(k for k, n in counts.items() if n):
        while i < len(ring) and ring[i][0] < slot:
            i += 1
        done, k = 0, i
        while done < counts[slot]:
            s = ring[k % len(ring)][1]
            if take := min(counts[slot] - done, room[s] - used[s]):
                runs.append((slot, done, done + take, s, used[s]))
                done, used[s] = done + take, used[s] + take
            k += 1
    return runs


def ring_position(*keys: Column | str) -> Column:
    """Where a row lies on the ring: a 64-bit hash of its keys."""
    return F.xxhash64(F.lit("ring"), *keys)


def assign_shards(df: DataFrame, keys: list[str], shards: int, vnodes: int = VNODES, bits: int = RING_BITS) -> DataFrame:
    """One row per row of ``df``, restricted to ``keys``, with ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    Rows whose keys are all equal are interchangeable: they are counted before the shuffle and dealt out again
    afterwards, in runs of ``RUN`` over several tasks, so one key with a third of the rows is one row until its places are known. Null keys hash like
    any other value. Only the row counts of the ring's slots (at most 2**bits) reach the driver; an empty input
    gives an empty result. Fewer rows than shards leave the last shards empty. Shard counts below 1 are refused.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    if {"shard", "slot"} & {*keys}:
        raise ValueError("a key may not be named shard or slot")
    spark = df.sparkSession
    n, p, s = (f"__{x}" for x in "nps")
    named = [F.col(f"`{k}`") for k in keys]
    rows = df.groupBy(*named).agg(F.count("*").alias(n)).withColumn(p, ring_position(*named)).withColumn(s, F.shiftrightunsigned(p, 64 - bits).cast("int"))
    rows = materialize(rows, "ring")
    counts = {r[0]: r[1] for r in rows.groupBy(s).agg(F.sum(n)).collect()}  # at most 2**bits rows
    runs = place(counts, shards, vnodes, bits)
    kind = "array<struct<__at:int,__from:long,__to:long,shard:int,__base:long>>"
    told = json.dumps([dict(zip(("__at", "__from", "__to", "shard", "__base"), r, strict=True)) for r in runs])
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(told), kind)))
    w = Window.partitionBy(s).orderBy(p, *named).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__hi", F.sum(n).over(w)).withColumn("__lo", F.col("__hi") - F.col(n))
    near = (F.col(s) == F.col("__at")) & (F.col("__from") < F.col("__hi")) & (F.col("__to") > F.col("__lo"))
    placed = rows.join(F.broadcast(plan), near)  # a row for each slot and split: 2**bits + shards at most
    placed = placed.select(*named, "shard", (F.greatest("__from", "__lo") - F.col("__from")).alias("__a"), (F.least("__to", "__hi") - 1 - F.col("__from")).alias("__z"), "__base")
    if not rows.where(F.col(n) > RUN).isEmpty():  # a very frequent row is cut into runs, which are dealt to several tasks
        starts = F.sequence("__a", "__z", F.lit(RUN).cast("long"))
        runs = placed.select(*named, "shard", "__z", "__base", F.explode(starts).alias("__a")).withColumn("__z", F.least("__z", F.col("__a") + RUN - 1))
        placed = runs.repartition(*named, "shard", "__a")
    placed = placed.select(*named, "shard", F.explode(F.sequence("__a", "__z")).alias("__i"), "__base")
    return placed.select(*named, "shard", (F.col("__base") + F.col("__i")).alias("slot"))
