"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

Entries become integers, ``floor(scale * entry)``, so that every sum over vectors is
exact and does not depend on how Spark deals the rows out:

1. each distinct integer vector is kept once (the fit list, a stored table);
2. tasks add up the entries of each dimension, then the products of entries less
   the rounded mean of their dimension, in integers; Spark adds the tasks' sums up;
3. n * (sum of products) - (what the rounding of the mean left) is the centred
   scatter times n, still an integer; divided once, it is the covariance V;
4. the driver, which holds dims x dims numbers whatever the number of rows,
   factors P'VP = LL' with diagonal pivots, and rotates pairs of columns of L until
   they are orthogonal.  Their squared norms are the eigenvalues, and the normalised
   columns the components;
5. every row is centred with the exact mean and projected.

Defined results: a row whose vector is null, or holds a null, NaN or infinite
entry, is left out.  A vector shorter than the longest of the table is read as if
zeros followed; scaled entries beyond a long's range are its least or greatest
value.  Repeated rows and ids give a row each, null ids are kept, other columns are
not read, so they can have any name.  Of a component with eigenvalue zero (fewer
distinct vectors than components, or constant dimensions) ``whitened`` is null and
``explained`` 0, or null if the whole variance is zero.  ``deviation`` is null if it
passes a long; ``deviation_digits`` always has it.  Components are doubles: where
eigenvalues lie some 25 powers of ten apart, the coordinates of the smaller ones are
rounding, and ``identity_error`` says so.  An empty table, or one of empty
vectors, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.llm.textkit import stored

COMPONENTS = 4
SCALE = 256
LIMB = 21                 # products of two limbs of so many bits, over 2**11 rows, stay exact in doubles
BLOCK = 1 << (53 - 2 * LIMB)
SAFE = 1 << 61
HALF = 60                 # exact sums travel as two parts, the lower of so many bits


@dataclass
class Whitening:
    """What is fitted: the count and sums of the fit list, V's trace, eigenvalues and components (columns), all by falling eigenvalue."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray


def integer_vectors(df: DataFrame, vec_col: str, *keep, scale: int = SCALE) -> DataFrame:
    """``keep`` columns and ``x``, the integer vector, of rows whose vector is whole."""
    vec = F.col(vec_col).cast("array<double>")
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.select(*keep, vec.alias("v")).where(F.col("v").isNotNull() & whole)
    return rows.select(*[c for c in rows.columns if c != "v"], F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def filled(df: DataFrame, dims: int) -> DataFrame:
    """``x`` with zeros up to ``dims`` entries."""
    return df.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))))


# ------------------------------------------------------------------ exact sums in tasks

def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def less(x: np.ndarray, shift: list[int], times: int = 1) -> np.ndarray:
    """times * x - shift, as int64 where that cannot overflow, else as Python integers."""
    top = max(1, abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * times + max([1, *map(abs, shift)])
    if top < SAFE:
        return x * np.int64(times) - np.array(shift, np.int64)
    return x.astype(object) * times - np.array(shift, object)


def exact_gram(m: np.ndarray) -> np.ndarray:
    """m'm in Python integers: limbs of few bits are multiplied as doubles, without rounding."""
    total = np.zeros((m.shape[1], m.shape[1]), object)
    if m.dtype == object:
        return total + m.T @ m
    size, sign = np.abs(m), np.sign(m)
    n_limbs = max(1, -(-int(size.max(initial=0)).bit_length() // LIMB))
    for lo in range(0, len(m), BLOCK):
        part, s = size[lo:lo + BLOCK], sign[lo:lo + BLOCK]
        limbs = [(s * ((part >> (LIMB * k)) & ((1 << LIMB) - 1))).astype(np.float64) for k in range(n_limbs)]
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def sums_of(dims: int):
    """mapInArrow function: one row a dimension and task with the sum of its entries, and one with the count (dimension -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for batch in batches:
            x = matrix(batch, dims)
            n += len(x)
            safe = len(x) * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < SAFE
            total += (x if safe else x.astype(object)).sum(axis=0).astype(object)
        yield parts([-1, *range(dims)], [0] * (dims + 1), [n, *total.tolist()])

    return run


def scatter_of(dims: int, shift: list[int]):
    """mapInArrow function: the task's sum of products of shifted entries, one row for each pair of dimensions i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            total += exact_gram(less(matrix(batch, dims), shift))
        i, j = np.triu_indices(dims)
        yield parts(i, j, total[i, j].tolist())

    return run


def parts(i, j, values: list[int]) -> pa.RecordBatch:
    mask = (1 << HALF) - 1
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(int(v) >> HALF) for v in values]),
                                       pa.array([int(v) & mask for v in values], pa.int64())], names=["i", "j", "high", "low"])


def added(rows: DataFrame) -> dict[tuple[int, int], int]:
    """The tasks' integers of each place added up by Spark; as many rows as there are places reach the driver."""
    total = rows.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    return {(r.i, r.j): (int(r.high) << HALF) + int(r.low) for r in total.collect()}


PARTS = "i int, j int, high string, low long"


# ------------------------------------------------------------------ factorisation (dims x dims, on the driver)

def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = LL' (rows in a's order): columns by falling pivot, ended where every diagonal left is rounding of its entry."""
    a = np.array(a, np.float64)
    d = len(a)
    left, first = a.diagonal().copy(), a.diagonal().copy()
    noise = d * np.finfo(np.float64).eps * first
    cols: list[np.ndarray] = []
    free = np.ones(d, bool)
    while free.any():
        at = int(np.argmax(np.where(free, left, -np.inf)))
        if not (left[at] > noise[at]):
            # a small diagonal may still stand for itself where a large one is only rounding
            rest = np.flatnonzero(free & (left > noise))
            if not len(rest):
                break
            at = int(rest[np.argmax(left[rest])])
        col = a[:, at].copy()
        for c in cols:
            col -= c * c[at]
        col[~free] = 0.0
        col /= np.sqrt(left[at])
        col[at] = np.sqrt(left[at])
        cols.append(col)
        free[at] = False
        left = np.where(free, left - col * col, 0.0)
    return np.array(cols).T.reshape(d, len(cols))


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated in pairs until they are orthogonal; a sweep meets every pair once, disjoint pairs together."""
    u = np.array(factor, np.float64)
    r = u.shape[1]
    tol = np.sqrt(max(1, len(u))) * np.finfo(np.float64).eps
    players = list(range(r)) + ([-1] if r % 2 else [])
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(players) - 1):
            pairs = [(a, b) for a, b in zip(players[:len(players) // 2], reversed(players[len(players) // 2:])) if a >= 0 and b >= 0]
            players = [players[0], players[-1], *players[1:-1]]
            if not pairs:
                continue
            p, q = np.array(pairs).T
            x, y = u[:, p], u[:, q]
            a, b, g = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(g) / np.sqrt(np.maximum(a * b, np.finfo(np.float64).tiny))
            worst = max(worst, float(off.max()))
            turn = off > tol
            g = np.where(turn, g, 1.0)
            zeta = (b - a) / (2.0 * g)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1.0 + zeta * zeta))
            c = np.where(turn, 1.0 / np.sqrt(1.0 + t * t), 1.0)
            s = np.where(turn, c * t, 0.0)
            u[:, p], u[:, q] = c * x - s * y, s * x + c * y
        if worst <= tol:
            break
    return u


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit eigenvectors as columns."""
    scale = float(np.abs(v.diagonal()).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    u = jacobi_columns(pivoted_cholesky(v / scale))
    norms = np.sqrt((u * u).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2 * scale, u[:, order] / norms[order]


# ------------------------------------------------------------------ the operator

def fit_whitening(fit: DataFrame, dims: int) -> Whitening:
    """``fit``: distinct integer vectors ``x`` of ``dims`` entries."""
    sums = added(fit.mapInArrow(sums_of(dims), PARTS))
    n = sums.get((-1, 0), 0)
    if not n:
        return Whitening(0, [0] * dims, 0.0, np.zeros(0), np.zeros((dims, 0)))
    s = [sums[d, 0] for d in range(dims)]
    shift = [(2 * x + n) // (2 * n) for x in s]                      # the mean, rounded
    rest = [x - n * r for x, r in zip(s, shift)]
    m = added(fit.mapInArrow(scatter_of(dims, shift), PARTS))
    v = np.zeros((dims, dims))
    for (i, j), total in m.items():
        v[i, j] = v[j, i] = (n * total - rest[i] * rest[j]) / (n * n)  # integers up to here: rounded once
    values, components = principal(v)
    trace = sum(n * m[d, d] - rest[d] * rest[d] for d in range(dims)) / (n * n)
    return Whitening(n, s, trace, values, components)


def projected(model: Whitening, k: int):
    """mapInArrow function: whitened coordinates and deviations of integer vectors, other columns kept."""
    n, sums, dims = model.n, model.sums, len(model.sums)
    known = min(k, len(model.values))
    turn = model.components[:, :known] / np.sqrt(model.values[:known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = less(matrix(batch, dims), sums, n)
            w = (away.astype(np.float64) / n) @ turn
            top = max(abs(int(away.max())), abs(int(away.min())))
            wide = away if away.dtype != object and top * top * dims < SAFE else away.astype(object)
            dev = (wide * wide).sum(axis=1).tolist()
            rows = [[*row, *[None] * (k - known)] for row in w.tolist()]
            keep = [batch.column(c) for c in batch.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(rows, pa.list_(pa.float64())), pa.array([d if d < 1 << 63 else None for d in dev], pa.int64()), pa.array([str(d) for d in dev])],
                names=[*[c for c in batch.schema.names if c != "x"], "w", "deviation", "deviation_digits"])

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each row of ``df`` with a whole vector and each component up to
    ``components``: vec_id, component, n, deviation, whitened, explained, identity_error
    (the largest entry of whitened's covariance over the fit list minus the identity,
    over components with an eigenvalue above zero), eigenvalue, deviation_digits."""
    spark = df.sparkSession
    rows = integer_vectors(df, vec_col, F.col(id_col).alias("vec_id"), scale=scale)
    out = f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, deviation_digits string"
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return spark.createDataFrame([], out)
    fit = stored(filled(rows.select("x"), dims).distinct(), "whitening-fit")
    model = fit_whitening(fit, dims)
    k = min(components, dims)
    known = min(k, len(model.values))
    error = None
    if known:
        w = fit.mapInArrow(projected(model, k), "w array<double>, deviation long, deviation_digits string")
        pairs = [(i, j) for i in range(known) for j in range(i, known)]
        got = w.agg(*[F.covar_pop(w["w"][i], w["w"][j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = float(max(abs(c - (i == j)) for c, (i, j) in zip(got, pairs)))
    share = [float(model.values[c] / model.trace) if c < known else (0.0 if model.trace else None) for c in range(k)]
    value = [float(model.values[c]) if c < known else 0.0 for c in range(k)]
    one = filled(rows, dims).mapInArrow(projected(model, k), f"vec_id {dict(rows.dtypes)['vec_id']}, w array<double>, deviation long, deviation_digits string")
    facts = F.array(*[F.struct(F.lit(c + 1).alias("component"), F.col("w")[c].alias("whitened"), F.lit(share[c]).cast("double").alias("explained"),
                               F.lit(value[c]).alias("eigenvalue")) for c in range(k)])
    flat = one.select("vec_id", "deviation", "deviation_digits", F.inline(facts))
    return flat.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                       F.lit(error).cast("double").alias("identity_error"), "eigenvalue", "deviation_digits")
