"""Whitening of embeddings: the leading eigenpairs of their covariance by a distributed Jacobi-Davidson iteration.

Entries become whole numbers x = floor(64 * c) + 1000000. The fit list is each distinct vector once, packed in blocks and
written to the shared folder. The covariance matrix is never formed: the iteration asks for products V u, for a block of
vectors u at a time, and each such product is one pass of Spark over the blocks: a task centres its rows, multiplies,
and sends one small matrix; tasks are added up in a middle layer of sqrt(tasks) tasks before the driver adds the rest
(compensated sums throughout). The driver holds only a few vectors of the dimension.

The iteration (``jacobi_davidson``): Rayleigh-Ritz on a subspace whose products are kept; pairs whose residual has reached
double precision are locked; for the others the projected correction equation (I - QQ')(V - theta)(I - QQ') t = -r is
solved roughly by MINRES, all in lockstep so that a step is one pass; the solutions, orthogonalised, extend the subspace,
which is restarted from its best vectors when it is large.

Whitened values are (x - S/n) projected on each unit component, over the root of its eigenvalue. ``identity_error`` is
measured in one more pass over the fit list.

Defined cases: a vector that is null, or holds a null, non-finite or absurdly large entry (64 * c beyond 2**50), takes no
part; shorter vectors count as filled up with c = 0; rows with a null or repeated id stay, each by itself. Directions
without variance (eigenvalue at most d * 2**-52 of the largest) are no components, so equal vectors give no rows, nor
does an empty table. Eigenvalues that tie share their space: any orthonormal basis of it may come. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, map_batches, stored, table

SCALE, SHIFT = 64, 1_000_000
EPS = 2.0**-52
#: So many partial sums come to the driver as they are; more are first added up by tasks.
FEW = 64


def whole_numbers(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x array<long>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(2.0**50 / SCALE)))
    return rows.where(v.isNotNull() & F.coalesce(good, F.lit(False))).select(
        F.col(id_col).alias("id"), F.transform(v, lambda c: F.floor(c * float(SCALE)).cast("long") + SHIFT).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of whole numbers, filled up with x of c = 0."""
    sizes = np.asarray(column.value_lengths())
    out = np.full((len(sizes), width), SHIFT, np.int64)
    flat = np.asarray(column.flatten())
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def added(total: tuple[np.ndarray, np.ndarray] | None, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A compensated sum (sum, lost) with ``x`` added."""
    if total is None:
        return x.copy(), np.zeros_like(x)
    s = total[0] + x
    big = np.abs(total[0]) >= np.abs(x)
    return s, total[1] + np.where(big, (total[0] - s) + x, (x - s) + total[0])


class Blocks:
    """The fit list in blocks of whole numbers, and passes over it."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width = blocks, width
        self.tasks = blocks.rdd.getNumPartitions()
        self.n, self.sums = 0, [0] * width
        self.passes = 0

    def total(self, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of the arrays (float64, one shape) that ``fn`` makes from a block's rows."""
        width = self.width

        def emit(total):
            if total is not None:
                yield pa.RecordBatch.from_pydict({"v": pa.array([np.stack([t.ravel() for t in total]).tobytes()], pa.binary())})

        def part(batches):
            total = None
            for batch in batches:
                for b in batch["block"]:
                    total = added(total, fn(np.frombuffer(b.as_buffer(), np.int64).reshape(-1, width)))
            yield from emit(total)

        def add(batches):
            total = None
            for batch in batches:
                for v in batch["v"]:
                    total = _both(total, v.as_buffer())
            yield from emit(total)

        parts = map_batches(self.blocks, part, "v binary")
        if self.tasks > FEW:
            parts = map_batches(parts.repartition(max(2, math.isqrt(self.tasks))), add, "v binary")
        self.passes += 1
        total = None
        for row in parts.collect():
            total = _both(total, row["v"])
        return total[0] + total[1]

    def measure(self) -> None:
        """n and the exact sums of each dimension (two halves of a number, so that no sum overflows)."""
        cut = 2**25

        def fn(x):
            return np.concatenate([[len(x)], (x // cut).sum(axis=0), (x % cut).sum(axis=0)]).astype(float)

        got = self.total(fn)
        self.n = int(got[0])
        self.sums = [int(h) * cut + int(lo) for h, lo in zip(got[1:self.width + 1], got[self.width + 1:])]

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        """x - S/n of rows, to double precision: the whole part of the mean goes first."""
        n, whole = self.n, np.array([s // self.n for s in self.sums])
        rest = np.array([(s % n) / n for s in self.sums])
        return lambda x: (x - whole).astype(float) - rest

    def product(self, u: np.ndarray) -> np.ndarray:
        """V u, V being the covariance with divisor n."""
        centred, shape = self.centred(), u.shape

        def fn(x):
            c = centred(x)
            return (c.T @ (c @ u)).ravel()

        return self.total(fn).reshape(shape) / self.n


def _both(total, buffer):
    two = np.frombuffer(buffer, float).reshape(2, -1)
    total = added(total, two[0])
    return total[0], total[1] + two[1]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Columns x that roughly solve apply(x) = rhs, each column by itself; ``apply`` is symmetric for each column."""
    norm = lambda a: np.sqrt((a * a).sum(axis=0))
    safe = lambda a: np.where(a == 0, 1, a)
    first = norm(rhs)
    v, old = rhs / safe(first), np.zeros_like(rhs)
    x, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    beta, eta = np.zeros(rhs.shape[1]), first.copy()
    c = c_old = np.ones(rhs.shape[1])
    s = s_old = np.zeros(rhs.shape[1])
    for _ in range(steps):
        open_ = np.abs(eta) > tol * first
        if not open_.any():
            break
        p = apply(v) - beta * old
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v
        nxt = norm(p)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, nxt)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        open_ &= rho > 0
        c_old, c = c, delta / safe(rho)
        s_old, s = s, nxt / safe(rho)
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe(rho)
        x = x + np.where(open_, c * eta, 0) * w
        eta = np.where(open_, -s * eta, 0)
        old, v, beta = v, p / safe(nxt), nxt
    return x


def orthonormal(new: np.ndarray, *bases: np.ndarray, least: float = 1e-8) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``bases``; columns that add next to nothing go."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for b in (*bases, out):
                column = column - b @ (b.T @ column)
            left = np.linalg.norm(column)
            if left < least:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 5, steps: int = 6,
                    largest: int | None = None, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns, residual norms) of the ``k`` largest eigenvalues.

    ``product(u)`` gives the symmetric matrix times the columns of u. A pair is locked when its residual is at most
    d * 2**-52 of the largest value (rounding of the products); ``largest``: size of the subspace at which it restarts.
    """
    k = min(k, d)
    largest = largest or max(4 * k, 20)
    locked, values = np.zeros((d, 0)), []
    basis = orthonormal(np.random.default_rng(seed).normal(size=(d, min(d, 2 * k))))
    image = product(basis)
    lowest, stuck = math.inf, 0
    for _ in range(rounds):
        theta, s = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        basis, image = basis @ s, image @ s
        need = k - len(values)
        rest = image[:, :need] - basis[:, :need] * theta[:need]
        norms = np.sqrt((rest * rest).sum(axis=0))
        scale = max([abs(theta[0]), *map(abs, values)], default=0.0)
        full = basis.shape[1] + locked.shape[1] >= d
        done = norms <= max(d, 16) * EPS * scale
        if full or stuck > 3:      # nothing is left to add: what remains is rounding
            done[:] = True
        if done.any():
            # only pairs before the first open one are locked, so that none is passed over
            upto = int(np.argmin(done)) if not done.all() else len(done)
            locked = np.column_stack([locked, basis[:, :upto]])
            values += list(theta[:upto])
            basis, image, rest, theta = basis[:, upto:], image[:, upto:], rest[:, upto:], theta[upto:]
            norms = norms[upto:]
            if upto:
                lowest, stuck = math.inf, 0
        if len(values) >= k:
            break
        need = k - len(values)
        if norms[0] < lowest * 0.9:
            lowest, stuck = norms[0], 0
        else:
            stuck += 1
        near = np.column_stack([locked, basis[:, :need]])
        cut = lambda y, near=near: y - near @ (near.T @ y)
        shift = theta[:need]
        t = minres(lambda y, cut=cut, shift=shift: cut(product(cut(y)) - shift * cut(y)), -cut(rest), steps, 0.05)
        if basis.shape[1] + need > largest and basis.shape[1] > 2 * need:
            basis = orthonormal(basis[:, :2 * need], locked)
            image = product(basis)
        t = orthonormal(t, locked, basis)
        if not t.shape[1]:
            stuck = 4
            continue
        basis, image = np.column_stack([basis, t]), np.column_stack([image, product(t)])
    values, vectors = np.array(values), locked
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    check = product(vectors) - vectors * values
    return values, vectors, np.sqrt((check * check).sum(axis=0))


def whiten(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 5) -> DataFrame:
    """(id, component, n, deviation decimal, whitened, explained, identity_error, eigenvalue, residual) of each row and component.

    ``deviation``: exact sum over dimensions of (n * x - S)^2, null beyond 38 digits. ``residual``: |V u - e u| of the
    component as measured at the end.
    """
    spark = rows.sparkSession
    kind = rows.select(id_col).schema[0].dataType.simpleString()
    schema = (f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double, eigenvalue double, residual double")
    data = whole_numbers(rows, id_col, vec_col)
    width = data.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    filled = F.when(F.size("x") < width, F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x")))).otherwise(F.col("x"))
    distinct = data.select(filled.alias("x")).distinct()
    packed = arrow_map(distinct, lambda b: {"block": pa.array([matrix(b["x"], width).tobytes()], pa.binary())}, "block binary")
    fit = Blocks(stored(packed, "whiten-fit"), width)
    fit.measure()
    n, sums, centred = fit.n, fit.sums, fit.centred()
    values, vectors, residuals = jacobi_davidson(fit.product, width, components, seed)
    live = values > max(width, 16) * EPS * max(values.max(initial=0.0), 0.0)
    values, vectors, residuals = values[live], vectors[:, live], residuals[live]
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    onto = vectors / np.sqrt(values)

    def spread(x):
        c = centred(x)
        z = c @ onto
        return np.concatenate([[(c * c).sum()], z.sum(axis=0), (z.T @ z).ravel()])

    got = fit.total(spread)
    trace, mean = got[0] / n, got[1:k + 1] / n
    identity_error = float(np.abs(got[k + 1:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    big = np.array(sums, object)

    def project(batch: pa.RecordBatch):
        x = matrix(batch["x"], width)
        m = len(x)
        z = centred(x) @ onto
        reach = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums)), 1)
        if reach * reach * width < 2**62:
            apart = n * x - np.array(sums, np.int64)
            deviation = [int(v) for v in (apart * apart).sum(axis=1)]
        else:
            deviation = [int((row * row).sum()) for row in n * x.astype(object) - big]
        deviation = pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
        at = np.repeat(np.arange(m), k)
        return {"id": batch["id"].take(pa.array(at)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, n), "deviation": deviation.take(pa.array(at)), "whitened": z.ravel(),
                "explained": np.tile(values / trace, m), "identity_error": np.full(m * k, identity_error),
                "eigenvalue": np.tile(values, m), "residual": np.tile(residuals, m)}

    return arrow_map(data, project, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 16 leading components."""
    got = whiten(table(spark, sf_dir, "embeddings"))
    return got.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as long)").alias("deviation"),
                      "whitened", "explained", "identity_error")
