"""Exact joins of sets by their Jaccard likeness, with prefixes of rare members."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import broadcast_if_small, materialize

EPS = 1e-9  # by which bounds are loosened against rounding; the last comparison is exact
MEETINGS = 100  # meetings of prefixes a set, beyond which sets are compared in blocks instead
COMMON = 4_096  # members that are columns of a matrix there, at most
BLOCK = 65_536  # sets in a block, at most
MEMBERS = 1 << 22  # their members, at most
GRID = 8  # blocks a side, at least
TILE = 1 << 19  # pairs of a block compared in one go
WIDE = 2_048  # sets of the right side among them
SLAB = 1 << 24  # entries of a matrix
TASKS = 4_096  # tasks that compare blocks, at most
MEETING = 450  # columns that take as long to multiply as one meeting to add (measured)


def by_rarity(sets: DataFrame, codes: DataFrame) -> DataFrame:
    """(row, id, n, s): the size of each set and the codes of its members that have one, in their order; ``row`` tells sets with one id apart."""
    members = sets.select(F.monotonically_increasing_id().alias("row"), "id", F.size("s").alias("n"), "s").select("row", "id", "n", F.explode("s").alias("term")).join(codes, "term")
    return members.groupBy("row", "id", "n").agg(F.array_sort(F.collect_list("code")).alias("s"))


def set_join(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """(a, b, likeness) of sets (id, s: array of distinct strings) of ``left`` and ``right`` that are alike by strictly more than ``threshold``.

    Without ``right`` pairs are those of ``left`` with itself, a < b. Two sets that are alike enough share a member within the
    first n - floor(threshold n) of both, if members are ordered by rarity; so only these prefixes are joined, and only where
    sizes, and what can still follow that member, leave the threshold in reach. A member that all sets have is last in all
    of them and in no prefix, unless the set has few others. Members that no two sets can share come first in that order and are
    only counted. What meets is compared in full. Where prefixes would meet more than ``MEETINGS`` times a set, as they do under
    a low threshold, all sets are compared by ``in_blocks`` with the same result. Sets without members or with a null id are in no
    pair; sets that have the same id are compared each for itself.
    """
    own = right is None
    sides = [d.where(F.col("id").isNotNull() & (F.size("s") > 0)).select("id", "s") for d in ([left] if own else [left, right])]
    members = sides[0].select(F.explode("s").alias("term"), F.lit(1).alias("x"), F.lit(0).alias("y"))
    for d in sides[1:]:
        members = members.unionByName(d.select(F.explode("s").alias("term"), F.lit(0).alias("x"), F.lit(1).alias("y")))
    counts = members.groupBy("term").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).where("x > 1" if own else "x > 0 and y > 0")
    codes = materialize(counts.orderBy(F.col("x") + F.col("y"), "term").select("term", F.monotonically_increasing_id().alias("code")), "codes")
    codes = broadcast_if_small(codes, codes.count())
    ordered = [materialize(by_rarity(d, codes), "sets") for d in sides]
    unshared = F.col("n") - F.size("s")
    prefix = F.slice("s", F.lit(1), F.greatest(F.col("n") - F.floor(F.greatest(F.col("n") * threshold - EPS, F.lit(0.0))) - unshared, F.lit(0)).cast("int"))

    def heads(d: DataFrame, i: str) -> DataFrame:
        return d.select(F.col("row").alias(i), F.col("n").alias(f"n{i}"), unshared.alias(f"u{i}"), F.posexplode(prefix).alias(f"p{i}", "term")).withColumn(f"p{i}", F.col(f"p{i}") + F.col(f"u{i}"))

    heads_of = [heads(d, "a").groupBy("term").count() for d in ordered]
    both = heads_of[0].select("term", F.col("count").alias("x")).join(heads_of[-1], "term").agg(F.sum(F.col("x").cast("double") * F.col("count"))).first()[0]
    if (both or 0) > MEETINGS * sum(d.count() for d in ordered):
        return in_blocks(ordered[0], None if own else ordered[1], threshold)
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    shared = 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    near = (small >= large * threshold - EPS) & (shared * (1 + threshold) >= (F.col("na") + F.col("nb")) * threshold - EPS)
    met = heads(ordered[0], "a").join(heads(ordered[-1], "b"), "term").where(near & (F.col("a") < F.col("b")) if own else near).select("a", "b").distinct()
    full = [d.select(F.col("row").alias(i), F.col("id").alias(f"id{i}"), F.col("s").alias(x), F.col("n").alias(f"n{i}")) for d, i, x in ((ordered[0], "a", "x"), (ordered[-1], "b", "y"))]
    j = met.join(full[0], "a").join(full[1], "b")
    c = F.size(F.array_intersect("x", "y"))
    out = j.select(F.col("ida").alias("a"), F.col("idb").alias("b"), (c / (F.col("na") + F.col("nb") - c)).alias("likeness")).where(F.col("likeness") > threshold)
    return least_first(out) if own else out


def least_first(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, likeness) of different ids, a < b."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").where("a < b")


def cut_by_size(sizes: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Blocks of sets from (size, sets, members): (size, its first block, its blocks) of each size, and (least, greatest size) of each block."""
    most = min(BLOCK, -(-sum(c for _, c, _ in sizes) // GRID))
    places, blocks, rows, members = [], [], 0, 0
    for n, count, m in sorted(sizes):
        parts = max(-(-count // most), -(-m // MEMBERS))
        if blocks and parts == 1 and rows + count <= most and members + m <= MEMBERS:
            blocks[-1] = (blocks[-1][0], n)
            places.append((n, len(blocks) - 1, 1))
            rows, members = rows + count, members + m
        else:
            places.append((n, len(blocks), parts))
            blocks += [(n, n)] * parts
            rows, members = (count, m) if parts == 1 else (most, MEMBERS)  # nothing is added to parts of a size
    return places, blocks


def in_blocks(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """The result of ``set_join`` for (row, id, n, s) from ``by_rarity``, by comparing blocks of sets of a similar size with blocks.

    Pairs of blocks whose sizes leave the threshold out of reach are not compared. A set is moved once for each block it meets; only
    pairs that are alike leave a task, with their likeness, so no candidates are shuffled. Time grows with the product of both sides,
    a task's memory does not.
    """
    own, sides = right is None, [left] if right is None else [left, right]
    spark, kind = left.sparkSession, {x: dict(d.dtypes)["id"] for x, d in (("a", left), ("b", sides[-1]))}
    cuts = [cut_by_size([tuple(r) for r in d.groupBy("n").agg(F.count("*"), F.sum(F.size("s"))).collect()]) for d in sides]  # a row a size
    fits = lambda x, y: min(x[1], y[1]) >= max(x[0], y[0]) * threshold - EPS
    met = [(i, j) for i, x in enumerate(cuts[0][1]) for j, y in enumerate(cuts[-1][1]) if (j >= i or not own) and fits(x, y)]
    tasks = max(1, min(TASKS, len(met)))
    pairs = spark.createDataFrame([(i, j, k % tasks) for k, (i, j) in enumerate(met)], "i int, j int, task int")

    def dealt(p: DataFrame, k: int, name: str) -> DataFrame:
        at = spark.createDataFrame(cuts[k][0], "n int, first int, parts int")
        p = p.join(broadcast_if_small(at, len(cuts[k][0])), "n").withColumn(name, F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        p = p.join(broadcast_if_small(pairs, len(met)), name)
        is_right, none = name == "j", F.lit(None)
        return p.select("i", "j", F.lit(is_right).alias("right"), (none.cast(kind["a"]) if is_right else F.col("id")).alias("a"), (F.col("id") if is_right else none.cast(kind["b"])).alias("b"), "n", "s", "task")

    rows = dealt(sides[0], 0, "i").unionByName(dealt(sides[0], 0, "j").where("i <> j") if own else dealt(sides[1], 1, "j"))
    rows = rows.repartitionById(tasks, "task").sortWithinPartitions("i", "j", "right").drop("task")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            i, j = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (i[lo], j[lo]):
                    yield from alike(pa.concat_batches(held))
                    held = []
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from alike(pa.concat_batches(held))

    def alike(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        same = own and t.column(0)[0].as_py() == t.column(1)[0].as_py()
        cut = t.num_rows if same else int((~t.column(2).to_numpy(zero_copy_only=False)).sum())
        x, y = t.slice(0, cut), t if same else t.slice(cut)
        if not x.num_rows or not y.num_rows:
            return
        for p, q, like in alike_rows(sets_of(x), sets_of(y), threshold):
            if same:
                p, q, like = p[later := p < q], q[later], like[later]
            yield pa.RecordBatch.from_arrays([x.column(3).take(pa.array(p)), y.column(3 if same else 4).take(pa.array(q)), pa.array(like)], ["a", "b", "likeness"])

    out = rows.mapInArrow(compare, f"a {kind['a']}, b {kind['b']}, likeness double")
    return least_first(out) if own else out


class Sets(NamedTuple):
    """Sets as rows: their sizes, where each one's codes begin, and the codes, which may be fewer than the size."""

    n: np.ndarray
    at: np.ndarray
    codes: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), np.diff(self.at))

    def take(self, rows: np.ndarray) -> Sets:
        size = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(size)])
        return Sets(self.n[rows], at, self.codes[np.repeat(self.at[rows] - at[:-1], size) + np.arange(at[-1])])

    def kept(self, keep: np.ndarray, codes: np.ndarray) -> Sets:
        return Sets(self.n, np.concatenate([[0], np.cumsum(keep)])[self.at], codes[keep])


def sets_of(d: pa.RecordBatch) -> Sets:
    return Sets(d.column(5).to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(d.column(6).value_lengths().to_numpy())]), d.column(6).flatten().to_numpy())


def ranked(x: Sets, y: Sets) -> tuple[Sets, Sets, np.ndarray]:
    """Both with only the codes they share, as ranks by falling number of pairs that have them; and that number of each rank."""
    known = np.intersect1d(x.codes, y.codes)
    if not len(known):
        return *(s.kept(np.zeros(len(s.codes), bool), s.codes) for s in (x, y)), np.zeros(0)
    place = [np.minimum(np.searchsorted(known, s.codes), len(known) - 1) for s in (x, y)]
    keep = [known[i] == s.codes for i, s in zip(place, (x, y), strict=True)]
    met = np.multiply(*(np.bincount(i[k], minlength=len(known)).astype(float) for i, k in zip(place, keep, strict=True)))
    rank = np.empty(len(known), np.int32)
    rank[order := np.argsort(-met, kind="stable")] = np.arange(len(known))
    return x.kept(keep[0], rank[place[0]]), y.kept(keep[1], rank[place[1]]), met[order]


def alike_rows(x: Sets, y: Sets, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of x, row of y, likeness) of all pairs that are alike by more than ``threshold``.

    What two sets share of the most frequent members is a product of matrices, less what sets of their sizes need, by two more
    columns; each other member they share is added. As many members are columns as make both together the least work.
    """
    order = [np.argsort(s.n, kind="stable") for s in (x, y)]
    x, y, met = ranked(*(s.take(o) for s, o in zip((x, y), order, strict=True)))
    if not len(met):
        return
    widths = np.unique(np.minimum(np.arange(62, COMMON + 64, 64), min(COMMON, len(met))))
    left_over = met.sum() - np.concatenate([[0], np.cumsum(met)])[widths]
    columns = int(widths[np.argmin(left_over / len(x.n) / len(y.n) + widths / MEETING)])
    number = np.float32 if x.n[-1] + y.n[-1] < 1 << 17 else np.float64  # sums of 1/64 are exact
    need = lambda n: np.maximum(np.floor(threshold / (1 + threshold) * n * 64 - 1), 0) / 64

    def split(s: Sets, is_left: bool) -> tuple[np.ndarray, Sets]:
        m, frequent = np.zeros((len(s.n), columns + 2), number), s.codes < columns
        m[s.rows()[frequent], s.codes[frequent]] = 1
        m[:, columns], m[:, columns + 1] = (-need(s.n), 1) if is_left else (1, -need(s.n))
        return m, s.kept(~frequent, s.codes - columns)

    wide = min(WIDE, TILE)
    high, slab = max(1, TILE // wide), max(1, SLAB // (columns + 2))
    for top in range(0, len(x.n), slab):
        xs = x.take(np.arange(top, min(top + slab, len(x.n))))
        mx, fewer = split(xs, True)
        for j in range(0, len(y.n), wide):
            ys = y.take(np.arange(j, min(j + wide, len(y.n))))
            lo, hi = np.searchsorted(xs.n, ys.n[0] * threshold - EPS), len(xs.n) if threshold <= 0 else np.searchsorted(xs.n, ys.n[-1] / threshold + EPS, "right")
            if lo >= hi:
                continue
            my, others = split(ys, False)
            having = others.rows()[np.argsort(others.codes, kind="stable")].astype(np.int32)
            first = np.concatenate([[0], np.cumsum(np.bincount(others.codes, minlength=len(met) - columns))])
            for i in range(lo, hi, high):
                end = min(i + high, hi)
                over = (mx[i:end] @ my.T).ravel()
                codes = fewer.codes[fewer.at[i] : fewer.at[end]]
                add_met(over, np.repeat(np.arange(end - i, dtype=np.int32) * len(ys.n), np.diff(fewer.at[i : end + 1])), first[codes], first[codes + 1], having)
                hit = np.flatnonzero(over > 0)
                p, q = np.divmod(hit, len(ys.n))
                nx, ny = xs.n[p + i], ys.n[q]
                c = np.rint(over[hit] + need(nx) + need(ny))
                like = c / (nx + ny - c)
                if (ok := like > threshold).any():
                    yield order[0][p[ok] + top + i], order[1][q[ok] + j], like[ok]


def add_met(over: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, rows: np.ndarray) -> None:
    """Adds 1 to ``over`` at each of ``at`` + each of its ``rows`` from ``lo`` to ``hi``."""
    n = hi - lo
    lo, at, n = lo[some := n > 0], at[some], n[some]
    ends = np.cumsum(n)
    start = 0
    while start < len(n):  # no more than about TILE meetings at once
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TILE)))
        k = n[start:stop]
        place = np.repeat(lo[start:stop] - np.cumsum(k) + k, k) + np.arange(k.sum())
        np.add.at(over, np.repeat(at[start:stop], k) + rows[place], over.dtype.type(1))
        start = stop
