"""Whitening of embeddings along the leading principal components, found by LOBPCG."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

COMPONENTS = 16
GUARD = 8  # further directions that are iterated, so that a cluster of eigenvalues at the end converges too
TOLERANCE = 1e-13  # certified residual, against the largest eigenvalue
ROUNDS = 300
SCALE, SHIFT = 64, 1_000_000
#: |64 c| beyond this counts as this, so that sums of a batch stay exact.
CLAMP = float(1 << 40)


class Whitening(NamedTuple):
    """Mean (as ``sums`` / ``n``), components by falling eigenvalue, and what was certified."""

    n: int
    sums: np.ndarray  # exact, Python integers
    components: np.ndarray  # dimension x component
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray  # norm of V v - e v
    identity_error: float
    rounds: int


def fixed_points(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep`` and ``x`` (array<long>): floor(64 c) + 1000000 of every entry; rows with a null vector, a null or a non-finite entry are left out."""
    c = F.col(vector)
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform(c, lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(CLAMP)), F.lit(-CLAMP))) + F.lit(SHIFT))
    return df.where(c.isNotNull() & fine).select(*keep, x.alias("x"))


def common_length(points: DataFrame) -> int:
    """The length that most vectors have, the greater of equally frequent ones; 0 for an empty table."""
    r = points.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return r.d if r else 0


def matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly: as int64 where that is wide enough, else as Python integers."""
    if n * (max(int(x.max(initial=0)), -int(x.min(initial=0))) + 1) < 1 << 61:
        return x * n - np.array([int(s) for s in sums], np.int64)
    return x.astype(object) * n - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (scaled(x, n, sums) / n).astype(float)


def column_sums(points: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """(rows, exact sums by dimension); a task sends d sums."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(d, object)
        for b in batches:
            x = matrix(b, "x", d)
            n, s = n + len(x), s + x.sum(0).astype(object)
        if n:
            yield pa.record_batch({"i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "s": pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))})

    rows = points.mapInArrow(part, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row a dimension
    sums = np.zeros(d, object)
    for r in rows:
        sums[r.i] = int(r.s)
    return (int(rows[0].n) if rows else 0), sums


def block_product(points: DataFrame, n: int, sums: np.ndarray, right: np.ndarray, left: np.ndarray | None = None, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(L' V R, diagonal of L' V L) with V the covariance of ``points``; L is the identity if not given.

    One pass: each task sums its centred rows' products and sends a row a dimension; Spark adds them up. ``width`` pads the
    block to a fixed number of columns, so that all rounds run the same plan.
    """
    d, m = len(sums), right.shape[1]
    rows, m0 = (d if left is None else left.shape[1]), max(width or m, m)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc, own, some = np.zeros((rows, m)), np.zeros(rows), False
        for b in batches:
            y = centred(matrix(b, "x", d), n, sums)
            z = y if left is None else y @ left
            acc, own, some = acc + z.T @ (y @ right), own + (z * z).sum(0), True
        if some:
            cols = {"i": pa.array(range(rows), pa.int32()), "own": pa.array(own)}
            yield pa.record_batch(cols | {f"c{j}": pa.array(acc[:, j] if j < m else np.zeros(rows)) for j in range(m0)})

    kind = "i int, own double, " + ", ".join(f"c{j} double" for j in range(m0))
    got = points.mapInArrow(part, kind).groupBy("i").agg(*[F.sum(c).alias(c) for c in ["own", *(f"c{j}" for j in range(m))]]).collect()  # d rows of a block's width
    out, diagonal = np.zeros((rows, m)), np.zeros(rows)
    for r in got:
        out[r.i], diagonal[r.i] = r[2:], r.own
    return out / n, diagonal / n


def orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """Directions of ``block`` outside ``against``, orthonormal; dependent ones are dropped."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        for a in against:
            block = block - a @ (a.T @ block)
        if not block.size:
            return block
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10 * max(1.0, s[0])]
    for a in against:
        block = block - a @ (a.T @ block)
    return np.linalg.qr(block)[0] if block.size else block


def rayleigh_ritz(basis: np.ndarray, product: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, values) of the ``m`` greatest Ritz pairs on an orthonormal basis."""
    t = basis.T @ product
    e, y = np.linalg.eigh((t + t.T) / 2)
    return y[:, ::-1][:, :m], e[::-1][:m]


def lobpcg(product, d: int, k: int, guard: int = GUARD, tolerance: float = TOLERANCE, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ``k`` leading eigenpairs of a symmetric d x d operator known by its block products.

    Returns (values, vectors, residual norms, rounds). Each round takes one product, of an orthonormal basis of iterate,
    residual and previous direction blocks (at most 3 (k + guard) columns), and a Rayleigh-Ritz step on it. It ends when the
    residuals of all k are at most ``tolerance`` times the greatest value, or can fall no more in double precision; residuals
    over 1e-9 after ``rounds`` raise an error.
    """
    b = min(d, k + guard)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, b)))[0]
    x = p = None
    best, still = np.inf, 0
    for done in range(1, rounds + 1):
        made = product(basis)
        y, e = rayleigh_ritz(basis, made, b)
        old, x, vx = x, basis @ y, made @ y
        p = np.zeros((d, 0)) if old is None else x - old @ (old.T @ x)
        r = vx - x * e
        size = np.linalg.norm(r, axis=0)[:k]
        worst = size.max(initial=0.0)
        still = 0 if worst < best / 2 else still + 1
        best = min(best, worst)
        if worst <= tolerance * max(e[0], 0.0) or (still >= 3 and worst <= 1e-11 * e[0]):
            return e[:k], x[:, :k], size, done
        x = np.linalg.qr(x)[0] if np.abs(x.T @ x - np.eye(b)).max() > 1e-12 else x
        w = orthonormal(r, [x])
        basis = np.hstack([x, w, orthonormal(p, [x, w])])
    if worst > 1e-9 * e[0]:
        raise RuntimeError(f"LOBPCG: residual {worst:.3g} of {e[0]:.3g} after {rounds} rounds")
    return e[:k], x[:, :k], size, rounds


def fit_whitening(points: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors ``x`` of length ``d``; None if there are none or all are equal.

    Distinct vectors are written once, without gathering a group; every round reads them once. What reaches the driver is
    d rows of 3 (components + 8) numbers at most. Directions without variance (below 1e-12 of the greatest) are no components.
    """
    fit = materialize(points.where(F.size("x") == d).select("x").distinct(), "fit")
    n, sums = column_sums(fit, d) if d else (0, np.zeros(0, object))
    if n < 2:
        return None
    k, trace = min(components, d), [0.0]
    width = min(d, 3 * min(d, k + GUARD))

    def product(block: np.ndarray) -> np.ndarray:
        out, diagonal = block_product(fit, n, sums, block, width=width)
        trace[0] = float(diagonal.sum())
        return out

    e, v, size, rounds = lobpcg(product, d, k)
    keep = e > 1e-12 * max(e[0], 0.0)
    e, v, size = e[keep], v[:, keep], size[keep]
    if not len(e):
        return None
    a = v / np.sqrt(e)
    return Whitening(n, sums, v, e, trace[0], size, float(np.abs(whitened_covariance(fit, n, sums, a) - np.eye(len(e))).max()), rounds)


def whitened_covariance(points: DataFrame, n: int, sums: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Covariance of the projections (x - S / n) a, whose mean is 0 but for rounding."""
    return block_product(points, n, sums, a, left=a)[0]


def whiten(points: DataFrame, key: str, model: Whitening) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error, residual): a row for each vector and component.

    ``deviation`` is exact; beyond 63 bits it is null.
    """
    n, sums, a = model.n, model.sums, model.components / np.sqrt(model.eigenvalues)
    d, many = a.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            z = scaled(matrix(b, "x", d), n, sums)
            top = max(int(z.max()), -int(z.min()))
            if top * top * d >= 1 << 63:
                z = z.astype(object)
            far = [v if v < 1 << 63 else None for v in (z * z).sum(1).tolist()]
            w = (z / n).astype(float) @ a
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, many), pa.int32()), pa.array(w.ravel()))
            yield pa.record_batch([b.column(b.schema.get_field_index(key)), pa.array(far, pa.int64()), lists], names=[key, "deviation", "w"])

    kind = points.schema[key].dataType.simpleString()
    rows = points.where(F.size("x") == d).select(key, "x").mapInArrow(part, f"`{key}` {kind}, deviation long, w array<double>")
    at = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("component"))
    out = rows.select(key, "deviation", F.posexplode("w").alias("p", "whitened")).withColumn("component", (F.col("p") + 1).cast("int"))
    return out.select(
        key, "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", at(model.eigenvalues / model.trace).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"), at(model.residuals / model.eigenvalues[0]).alias("residual"),
    )


def whiten_embeddings(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every row of ``df`` that has a vector of finite numbers, along the leading components.

    The model comes from the distinct fixed-point vectors, so copies and hot vectors weigh once. Rows with a null vector or a
    null or non-finite entry give no row; nor do vectors of another length than most (the greater of equally frequent
    lengths). Null and repeated keys are kept as they are, other columns left out. No vectors, or only equal ones, give an
    empty result; fewer varied directions than ``components`` give fewer rows a vector. Entries beyond 2^40 / 64 count as that.
    """
    points = fixed_points(df, vector, key)
    model = fit_whitening(points, common_length(points), components)
    if model is None:
        kind = f"`{key}` {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
        return df.sparkSession.createDataFrame([], kind)
    return whiten(points, key, model)
