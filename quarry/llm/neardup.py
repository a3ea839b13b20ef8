"""Near-duplicate groups by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Each text becomes the set of its word shingles (64-bit hashes) and a signature of ``TREES`` orders, each a string of
   16-bit minima. Texts with equal sets are one class from here on; a class is represented by its least doc_id.
2. The signatures of each order are sorted (a range partitioning over all orders). In a scan, the longest common prefix
   of neighbours cuts the sorted rows into regions. Depth adapts to the region: a prefix shared by few classes stays
   shallow, a crowded one is followed on until it is not crowded or reaches the depth at which a pair at the
   threshold is still missed by all orders less than once in 10,000 times. There a region is kept whatever its size.
3. Within a region all classes are compared by their whole signatures, in pairs of blocks. A pair whose share of equal minima
   lies within five standard deviations of the threshold or above is a candidate; boilerplate that only shares a prefix is not.
4. Candidates that overlap form clusters. A cluster is cut into blocks, each pair of blocks is one small task that
   compares full sets, and a task returns no more links than it needs to connect what it has seen.
5. Components over the confirmed links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.components import connected_components
from quarry.session import broadcast_if_small, materialize

TREES = 32
WIDTH = 5
PERCENT = 80
CROWD = 32  # classes that share a prefix before the region is followed deeper
BLOCK = 192  # classes of a region or a cluster in one block
SIGMAS = 5  # standard deviations below the threshold at which a signature still makes a candidate
HELD = 1_000_000  # sorted rows of one open region that a task holds; a longer one is scanned in parts, at full depth
WORDS_KEPT = 150_000  # word hashes a worker remembers before it starts afresh; a speed bound only


def depth_for(percent: int, trees: int = TREES, miss: float = 1e-4) -> int:
    """The greatest depth at which a pair at the threshold is missed by all trees with at most this probability."""
    t, d = percent / 100, 1
    while (1 - t ** (d + 1)) ** trees <= miss:
        d += 1
    return d


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """UTF-8 text -> distinct 64-bit shingle hashes, ascending. A-Z fold; words are split at ASCII white space."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.width, len(h))
        s = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            s = s * np.uint64(0xD6E8FEB86659FD93) + h[j : len(h) - k + 1 + j]
        return np.unique(_mix(s))


class Signer:
    """Shingle sets -> (two set hashes, the signature: for each order ``deep`` 16-bit minima as bytes)."""

    def __init__(self, percent: int, trees: int = TREES):
        self.trees, self.deep = trees, depth_for(percent, trees)
        self.mult = np.array([xxhash.xxh3_64_intdigest(f"order{i}".encode()) | 1 for i in range(trees * self.deep)], dtype=np.uint64)

    def __call__(self, s: np.ndarray) -> tuple[int, int, bytes]:
        least = np.full(len(self.mult), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), 256):
            np.minimum(least, (s[at : at + 256, None] * self.mult[None, :]).min(axis=0), out=least)
        sums = _mix(s * np.uint64(3)).sum(dtype=np.uint64), _mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return *(int(x.astype(np.int64)) for x in sums), _mix(least).astype(">u2").tobytes()


def signatures(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, trees: int = TREES) -> DataFrame:
    """(doc_id, n, s1, s2, orders) of every row; without words n is 0 and the signature empty."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n", "s1", "s2", "orders"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(width), Signer(percent, trees)
        for b in batches:
            n, s1, s2, orders = [], [], [], []
            for t in b.column(1):
                s = shingle(t.as_py() or b"")
                a, c, x = sign(s) if len(s) else (0, 0, b"")
                n.append(len(s)), s1.append(a), s2.append(c), orders.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, s1, s2)), pa.array(orders, pa.binary())], names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, orders binary")


def region_depths(lcp: np.ndarray, deep: int, crowd: int) -> np.ndarray:
    """Depth of each sorted row's region; 0 for a row alone. ``lcp``: words shared with the row before."""
    depth = np.zeros(len(lcp), np.int64)
    active = np.ones(len(lcp), bool)
    for d in range(max(1, deep - 2), deep + 1):
        run = np.cumsum(lcp < d) - (lcp[:1] < d).sum()
        size = np.bincount(run)[run]
        done = active & (size > 1) & ((size <= crowd) | (d == deep))
        depth[done] = d
        active &= size > crowd
    return depth


def _region_ids(tree: np.ndarray, sig: np.ndarray, depth: np.ndarray) -> np.ndarray:
    key, out = _mix(tree.astype(np.uint64) + np.uint64(1)), np.zeros(len(tree), np.uint64)
    for d in range(sig.shape[1]):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, d].astype(np.uint64) + np.uint64(1))
        out = np.where(depth == d + 1, key + np.uint64(d + 1), out)
    return out.view(np.int64)


def sorted_regions(classes: DataFrame, percent: int, trees: int = TREES, crowd: int = CROWD) -> DataFrame:
    """(rep, region): the classes of each region of each sorted order. ``classes``: rep and orders.

    A region that lies across the edge of a task's range is given at full depth besides, so its parts meet by its prefix.
    """
    deep, kind = depth_for(percent, trees), dict(classes.dtypes)["rep"]
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    rows = classes.select("rep", "orders", tree).select("tree", F.substring("orders", 2 * deep * F.col("tree") + 1, F.lit(2 * deep)).alias("sig"), "rep")
    rows = rows.repartitionByRange("tree", "sig", "rep").sortWithinPartitions("tree", "sig", "rep")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the open region at least depth, from its first row
        first = True

        def cut(tree: np.ndarray, sig: np.ndarray, rep: pa.Array, last: bool) -> pa.RecordBatch:
            same = np.logical_and.accumulate((sig[1:] == sig[:-1]) & (tree[1:] == tree[:-1])[:, None], axis=1).sum(axis=1)
            lcp = np.concatenate([[0], same])
            depth = region_depths(lcp, deep, crowd)
            run = np.cumsum(lcp < max(1, deep - 2))
            edge = ((run == run[0]) & first) | ((run == run[-1]) & last)
            i = np.concatenate([np.flatnonzero(depth), np.flatnonzero(edge & (depth != deep))])
            at = np.concatenate([depth[depth > 0], np.full(len(i) - (depth > 0).sum(), deep)])
            return pa.RecordBatch.from_arrays([rep.take(pa.array(i)), pa.array(_region_ids(tree[i], sig[i], at))], ["rep", "region"])

        def joined() -> tuple:
            t, s, r = zip(*held, strict=True)
            return np.concatenate(t), np.concatenate(s), pa.concat_arrays(r)

        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), ">u2").reshape(b.num_rows, deep)
            held.append((b.column(0).to_numpy(), sig, b.column(2)))
            tree, sig, rep = joined()
            step = np.flatnonzero((tree[1:] != tree[:-1]) | (sig[1:, : max(1, deep - 2)] != sig[:-1, : max(1, deep - 2)]).any(axis=1)) + 1
            full = len(tree) > HELD
            at = int(step[-1]) if len(step) else len(tree) if full else 0
            if at:
                yield cut(tree[:at], sig[:at], rep.slice(0, at), not len(step))
                first = not len(step)
            held = [(tree[at:], sig[at:], rep.slice(at))] if at < len(tree) else []
        if held:
            yield cut(*joined(), True)

    return rows.mapInArrow(scan, f"rep {kind}, region long").distinct()


def least_equal(percent: int, trees: int = TREES) -> int:
    """Equal minima from which a pair of signatures is a candidate."""
    n, t = trees * depth_for(percent, trees), percent / 100
    return int(n * t - SIGMAS * (n * t * (1 - t)) ** 0.5)


def candidate_links(classes: DataFrame, percent: int, trees: int = TREES, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of classes whose signatures are alike enough, as many as connect them. ``classes``: rep and orders.

    Regions with the same members in several orders are compared once. A region is compared in pairs of blocks of at most about
    ``BLOCK`` classes, so no task depends on a region's size.
    """
    found = materialize(sorted_regions(classes, percent, trees, crowd), "regions")
    of = found.groupBy("region").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.min("rep").alias("least")).where("m > 1")
    of = of.groupBy("m", "x", "least").agg(F.min("region").alias("__r")).select("__r", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb"))
    rows = found.join(of, F.col("region") == F.col("__r")).select("rep", "region", "nb", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int").alias("blk"))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("blk", j).alias("i"), F.greatest("blk", j).alias("j")))
    rows = rows.select("rep", "region", "blk", F.explode(pair).alias("at"))
    own = classes.select(F.col("rep").alias("__rep"), "orders")
    rows = rows.join(own, F.col("rep") == F.col("__rep")).select("region", "at.i", "at.j", "blk", "rep", "orders")
    rows = rows.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "blk", "rep")
    kind, least, words = dict(classes.dtypes)["rep"], least_equal(percent, trees), trees * depth_for(percent, trees)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.concat_batches([held, b]) if held is not None else b
            key = np.column_stack([t.column(k).to_numpy() for k in range(3)])
            starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1]) if len(key) else np.zeros(0, np.int64)
            if len(starts):
                yield from linked(t.slice(0, int(starts[-1])), starts)
                held = t.slice(int(starts[-1]))
        if held is not None:
            yield from linked(held, np.array([0, held.num_rows]))

    def linked(t: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not t.num_rows:
            return
        sig = np.frombuffer(b"".join(t.column(5).to_pylist()), np.uint16).reshape(t.num_rows, words)
        lo, blk = t.column(1).to_numpy() == t.column(3).to_numpy(), t.column(3).to_numpy()
        left, right = [], []
        for a, z in zip(starts[:-1], starts[1:], strict=True):
            n = int(z - a)
            group = {k: k for k in range(n)}

            def find(k: int) -> int:
                while group[k] != k:  # noqa: B023
                    group[k] = k = group[group[k]]  # noqa: B023
                return k

            one_block = blk[a] == blk[z - 1]
            for k in range(n - 1 if one_block else int(lo[a:z].sum())):
                start = k + 1 if one_block else int(lo[a:z].sum())
                for x in np.flatnonzero((sig[a + k] == sig[a + start : z]).sum(axis=1) >= least):
                    p, q = find(k), find(start + int(x))
                    if p != q:
                        group[p] = q
                        left.append(a + k), right.append(a + start + int(x))
        yield pa.RecordBatch.from_arrays([t.column(4).take(pa.array(np.array(x, np.int64))) for x in (left, right)], ["a", "b"])

    return rows.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of the sets at ``left`` with those at ``right``, by blocks of a 0/1 matrix of shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(col, [at, at + 4096])
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[a:b], col[a:b] - at] = 1
        out += m[left] @ m[right].T
    return out.astype(np.int64)


def _links(ids: list, sets: list[np.ndarray], blocks: list[int], percent: int) -> list[tuple]:
    """Confirmed links that connect all the given classes that are linked, and no more than that takes."""
    b = np.array(blocks)
    lo, hi = b.min(), b.max()
    left, right = np.flatnonzero(b == lo), np.flatnonzero(b == hi)
    inter = _overlaps(sets, left, right)
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[right][None, :] - inter
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero((100 * inter >= percent * union) & (inter > 0)), strict=True):
        x, y = int(left[i]), int(right[j])
        p, q = find(x), find(y)
        if p != q:
            parent[p] = q
            if ids[x] != ids[y]:
                out.append((ids[x], ids[y]))
    return out


def confirm(docs: DataFrame, clusters: DataFrame, percent: int, width: int, repeated: bool) -> DataFrame:
    """(a, b): confirmed links between the classes (node, component) of ``clusters``."""
    n = clusters.count()
    sizes = clusters.groupBy("component").count()
    nodes = clusters.join(sizes, "component").withColumn("nb", F.ceil(F.col("count") / BLOCK).cast("int")).withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    text = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = text.join(broadcast_if_small(nodes.select("node", "component", "nb", "blk"), n), F.col("doc_id") == F.col("node"))
    if repeated:
        rows = rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["node", "h"]).drop("h")
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("blk", j).alias("i"), F.greatest("blk", j).alias("j")))
    rows = rows.select("node", "component", "blk", "text", F.explode(pair).alias("at"))
    kind = dict(docs.dtypes)["doc_id"]

    def compare(t: pa.Table) -> pa.Table:
        shingle = Shingler(width)
        ids = t.column("node").to_pylist()
        sets = [shingle(x.as_py() or b"") for x in t.column("text")]
        got = _links(ids, sets, t.column("blk").to_pylist(), percent) if len(ids) > 1 else []
        id_type = t.schema.field("node").type
        return pa.table({"a": pa.array([g[0] for g in got], id_type), "b": pa.array([g[1] for g in got], id_type)})

    return rows.groupBy("component", "at").applyInArrow(compare, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, trees: int = TREES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id and text; other columns are ignored).

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets; a text of fewer than
    ``width`` words is one shingle of them all; null, empty or blank text has no shingles and links with nothing. component_id
    is the least doc_id reachable; kept is doc_id = component_id. Rows that share a doc_id are one node and one result
    each. A null doc_id links with nothing: its component is null and it is kept. Empty input, empty result.
    """
    sig = materialize(signatures(docs, percent, width, trees), "signatures")
    repeated = not sig.groupBy("doc_id").count().where("count > 1 and doc_id is not null").isEmpty()
    known = sig.where("n > 0 and doc_id is not null")
    cls = materialize(known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.join(cls.select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), "rep"), (F.col("doc_id") == F.col("rep")) & (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")))
    reps = reps.select("rep", "orders")
    if repeated:  # equal ids with equal sets are several rows of one class
        reps = reps.dropDuplicates(["rep"])
    clusters = materialize(connected_components(candidate_links(reps, percent, trees)), "clusters")
    links = materialize(confirm(docs, clusters, percent, width, repeated), "links")
    groups = connected_components(links)
    if repeated:  # rows of one doc_id with different texts belong to several classes
        own = known.select("doc_id", "s1", "s2", "n").distinct().join(cls, ["s1", "s2", "n"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        groups = connected_components(links.union(own))
    of = cls.join(groups, F.col("rep") == F.col("node"), "left").select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("n").alias("cn"), F.coalesce("component", "rep").alias("of"))
    out = sig.select("doc_id", "n", "s1", "s2").join(of, (F.col("n") > 0) & (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn")), "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the least doc_id; all columns stay.

    Rows without an id or without words stay. Of rows that share a kept doc_id one stays.
    """
    found = materialize(near_duplicates(docs, percent, width), "groups")
    drop = found.where("not kept").select(F.col("doc_id").alias("__drop")).distinct()
    out = docs.join(broadcast_if_small(drop, found.where("not kept").count()), F.col("doc_id") == F.col("__drop"), "left_anti")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(out.where("doc_id is null"))
    return out

