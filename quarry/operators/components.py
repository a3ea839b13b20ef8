"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize, release


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b).

    The least neighbour of each node is a partial aggregate, written before it is joined back: a join between two plain tables is
    one that adaptive execution can split, so a hub's links are dealt over several tasks. It is never broadcast: the files of
    sorted ids are far smaller than their rows, which would pass through the driver in every step.
    """
    if large:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    m = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "least")
    j = both.join(m.hint("merge"), both.a == m.n)
    if large:
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(m.select(F.col("n").alias("a"), F.col("m").alias("b")))
    out = materialize(out.where("a <> b").distinct(), "star")
    release(m)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link to another; component is the least node reachable.

    Nodes are any orderable type. Null ends and self-links add nothing. Repeated links count once. An empty
    input gives an empty result. Ends when a round changes no link (a star forest is a fixed point).
    """
    e = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "cc")
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def state(d: DataFrame):
        return d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = None
    for _ in range(max_rounds):
        half = _star(e, True)
        release(e)
        e = _star(half, False)
        release(half)
        now = state(e)
        if now == before:
            nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return nodes.union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError("connected components did not settle")
