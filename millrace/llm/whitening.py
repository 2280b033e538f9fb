"""Embeddings whitened by the leading components of their covariance, found by Jacobi-Davidson.

An entry c becomes the whole number x = floor(256 c). The fit list holds each distinct x vector
once; n vectors, sums S. The covariance V = 1/n sum (x - S/n)(x - S/n)' is never formed: a Spark
job gives V times a few vectors at once, centred before it multiplies, from the fit list stored in
the shared folder as blocks of numbers. Every pass is such a job and its result has as many numbers
as the vectors have dimensions, times the vectors asked for; nothing on the driver grows with the rows.

``leading`` is the Jacobi-Davidson iteration over these products. A subspace is searched by
Rayleigh-Ritz; for the leading pairs (theta, u) whose residual r = Vu - theta u is not down to the
rounding of double numbers, the correction equation (I - QQ')(V - theta)(I - QQ') t = -r, Q the locked
vectors and u, is solved by a few steps of MINRES. The equations of all open pairs advance side by
side, so one job serves them all. A pair that has converged is locked, the largest first.

Results: a row whose vector is null or holds null, NaN or an infinite entry is dropped. A
vector shorter than the longest ends in zeros. Entries beyond the range of long are cut to it. Only
components with an eigenvalue above rounding are returned, so an empty table, a single distinct vector and
vectors without entries give no rows, and data of lower rank fewer than ``wanted`` components. Where
eigenvalues tie, any vectors of their space are returned. Repeated rows stay, with equal results. A deviation
beyond long is null. A null vec_id stays null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import materialize

SCALE = 256
WANTED = 4
EPS = float(np.finfo(float).eps)
INNER = 6  # steps of MINRES for a correction
WIDEST = 48  # vectors of the search space before it is cut back to its best
ROUNDS = 500
BLOCK_NUMBERS = 1 << 18  # numbers of a stored block

OUTPUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

Product = Callable[[np.ndarray], np.ndarray]


# --- the iteration: small matrices on the driver, products by the caller -------------------------

def _minres(rhs: np.ndarray, theta: float, known: np.ndarray, steps: int) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of MINRES for (I - QQ')(V - theta)(I - QQ') t = rhs, Q = ``known``: yields a vector, is sent V times it, returns t."""

    def project(x: np.ndarray) -> np.ndarray:
        return x - known @ (known.T @ x)

    v = project(rhs)
    gamma = float(np.linalg.norm(v))
    solution = np.zeros_like(v)
    if not gamma:
        return solution
    eta, least = gamma, gamma * 1e-3
    v_old, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c = c_old = 1.0
    s = s_old = 0.0
    for _ in range(steps):
        v = v / gamma
        image = yield v
        image = project(image - theta * v)
        delta = float(image @ v)
        v_new = project(image - delta * v - gamma * v_old)
        gamma_new = float(np.linalg.norm(v_new))
        a0 = c * delta - c_old * s * gamma
        a1 = float(np.hypot(a0, gamma_new))
        if not a1:
            break
        a2, a3 = s * delta + c_old * c * gamma, s_old * gamma
        c_old, c, s_old, s = c, a0 / a1, s, gamma_new / a1
        w_old, w = w, (v - a3 * w_old - a2 * w) / a1
        solution = solution + c * eta * w
        eta = -s * eta
        v_old, v, gamma = v, v_new, gamma_new
        if abs(eta) <= least or gamma_new <= EPS * abs(theta):
            break
    return solution


def _side_by_side(solvers: list[Generator], product: Product) -> list[np.ndarray]:
    """Run the solvers in lock-step, one product for what all of them ask in a step; their solutions."""
    solutions: dict[int, np.ndarray] = {}
    asked: dict[int, np.ndarray] = {}

    def advance(i: int, image: np.ndarray | None) -> None:
        try:
            asked[i] = solvers[i].send(image)
        except StopIteration as end:
            solutions[i] = end.value

    for i in range(len(solvers)):
        advance(i, None)
    while asked:
        turn, asked = asked, {}
        images = product(np.stack(list(turn.values()), axis=1))
        for column, i in enumerate(turn):
            advance(i, images[:, column])
    return [solutions[i] for i in range(len(solvers))]


def _fresh(vectors: np.ndarray, known: np.ndarray, chance: np.random.Generator) -> np.ndarray:
    """Orthonormal vectors for ``vectors``, orthogonal to ``known``; one that lies within the rest is replaced by chance."""
    dims = known.shape[0]
    found: list[np.ndarray] = []
    for x in vectors.T:
        if known.shape[1] + len(found) == dims:
            break
        for _ in range(8):
            size = np.linalg.norm(x)
            y = x / size if size else chance.standard_normal(dims)
            for _ in range(2):  # twice is enough
                y = y - known @ (known.T @ y)
                for z in found:
                    y = y - z * (z @ y)
            left = np.linalg.norm(y)
            if size and left > 1e-10:
                found.append(y / left)
                break
            x = chance.standard_normal(dims)
    return np.stack(found, axis=1) if found else np.zeros((dims, 0))


def leading(product: Product, dims: int, wanted: int = WANTED, *, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors (columns) of a symmetric matrix known by its products.

    Residuals are down to the rounding of doubles, relative to the largest eigenvalue.
    """
    wanted = min(wanted, dims)
    chance = np.random.default_rng(seed)
    locked = np.zeros((dims, 0))
    basis = _fresh(chance.standard_normal((dims, wanted + 2)), locked, chance)
    images = product(basis)
    top = 0.0
    for _ in range(ROUNDS):
        projected = basis.T @ images
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn  # now Ritz vectors, the best first
        top = max(top, float(np.abs(values).max(initial=0.0)))
        residuals = images - basis * values
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        limit = 16 * EPS * np.sqrt(dims) * top
        whole = locked.shape[1] + basis.shape[1] == dims  # no direction is left out
        done = 0
        while done < len(values) and locked.shape[1] + done < wanted and (whole or sizes[done] <= limit):
            done += 1
        locked = np.concatenate([locked, basis[:, :done]], axis=1)
        basis, images, values, residuals, sizes = basis[:, done:], images[:, done:], values[done:], residuals[:, done:], sizes[done:]
        if locked.shape[1] == wanted:
            break
        if basis.shape[1] > WIDEST:
            basis, images = basis[:, : 3 * wanted], images[:, : 3 * wanted]
        open_ = [i for i in range(min(wanted - locked.shape[1], basis.shape[1])) if sizes[i] > limit]
        solvers = [
            _minres(-residuals[:, i], float(values[i]), np.concatenate([locked, basis[:, i : i + 1]], axis=1), INNER) for i in open_
        ]
        corrections = _side_by_side(solvers, product)
        more = np.stack(corrections, axis=1) if corrections else chance.standard_normal((dims, 1))
        more = _fresh(more, np.concatenate([locked, basis], axis=1), chance)
        basis, images = np.concatenate([basis, more], axis=1), np.concatenate([images, product(more)], axis=1)
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} components have not converged in {ROUNDS} rounds")
    projected = locked.T @ product(locked)  # a last Rayleigh-Ritz over the locked vectors
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    vectors = locked @ turn[:, ::-1]
    return values[::-1], vectors / np.linalg.norm(vectors, axis=0)


# --- the fit list and the passes over it ---------------------------------------------------------

def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dims)


def _packed(dims: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            step = max(1, BLOCK_NUMBERS // dims)
            for at in range(0, len(x), step):
                part = x[at : at + step]
                low, high = int(part.min()), int(part.max())
                kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
                yield pa.record_batch(
                    [pa.array([len(part)], pa.int64()), pa.array([kind]), pa.array([part.astype(kind).tobytes()], pa.binary())],
                    ["rows", "kind", "data"],
                )

    return pack


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """Stored blocks as matrices of whole numbers, one row a vector."""
    for batch in batches:
        for kind, data in zip(batch.column("kind"), batch.column("data")):
            yield np.frombuffer(data.as_buffer(), kind.as_py()).reshape(-1, dims)


@dataclass
class FitList:
    """Distinct x vectors in blocks: their number, exact sums, and passes over them."""

    table: DataFrame
    dims: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # a quotient of whole numbers is rounded once

    def passed(self, shape: tuple[int, ...], of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all blocks of ``of_block`` (a matrix of centred rows -> an array of ``shape``): one job."""
        dims, mean = self.dims, self.mean

        def run(batches):
            total = np.zeros(shape)
            for x in _blocks(batches, dims):
                total += of_block(x - mean)
            yield pa.record_batch([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel())], ["at", "value"])

        found = self.table.mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(int(np.prod(shape)))
        out[found["at"].to_numpy()] = found["value"].to_numpy()
        return out.reshape(shape)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``vectors``."""
        return self.passed(vectors.shape, lambda c: c.T @ (c @ vectors)) / self.n

    def trace(self) -> float:
        return float(self.passed((1,), lambda c: np.array([np.einsum("ij,ij", c, c)]))[0]) / self.n


def _sums(table: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their dimensions: high and low halves of each number are added apart."""

    def run(batches):
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for x in _blocks(batches, dims):
            x = x.astype(np.int64)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        at = pa.array(np.arange(dims + 1), pa.int64())
        yield pa.record_batch([at, pa.array(np.append(high, n)), pa.array(np.append(low, 0))], ["at", "high", "low"])

    parts = table.mapInArrow(run, "at bigint, high bigint, low bigint").groupBy("at")
    found = {r["at"]: r for r in parts.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    if not found:
        return 0, []
    return found[dims]["high"], [(found[i]["high"] << 32) + found[i]["low"] for i in range(dims)]


def whole_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows with a vector of finite numbers."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return rows.filter(F.col("v").isNotNull() & finite).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint")).alias("x")
    )


def fit_list(rows: DataFrame) -> tuple[DataFrame, FitList | None]:
    """``rows`` (vec_id, x) with vectors of one length, and the list of their distinct vectors (None without entries)."""
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    even = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x"))))
    if not dims:
        return even, None
    distinct = even.select("x").distinct()  # copies meet in their task before they travel
    table = materialize(distinct.mapInArrow(_packed(dims), "rows bigint, kind string, data binary"), "fit-list")
    n, sums = _sums(table, dims)
    return even, FitList(table, dims, n, sums)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n x - S)^2 over the dimensions of each row; None beyond long."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(embeddings: DataFrame, *, wanted: int = WANTED, column: str = "embedding") -> DataFrame:
    """``OUTPUT`` rows: a row for each vector and component.

    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions, ``whitened`` the centred vector along the
    component over the root of its eigenvalue, ``explained`` the eigenvalue's share of the trace, and ``identity_error`` the largest
    absolute difference between the covariance of the whitened fit list and the identity.
    """
    rows, fit = fit_list(whole_vectors(embeddings, column))
    nothing = embeddings.sparkSession.createDataFrame([], OUTPUT)
    if fit is None or not fit.n:
        return nothing
    trace = fit.trace()
    if not trace:
        return nothing
    values, vectors = leading(fit.product, fit.dims, wanted)
    real = values > fit.dims * EPS * trace
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return nothing
    axes = vectors / np.sqrt(values)
    k, dims, n, sums, mean = len(values), fit.dims, fit.n, fit.sums, fit.mean
    centre = fit.passed((k,), lambda c: (c @ axes).sum(axis=0)) / n
    spread = fit.passed((k, k), lambda c: (c @ axes - centre).T @ (c @ axes - centre)) / n
    error = float(np.abs(spread - np.eye(k)).max())
    shares = values / trace

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), dims)
            whitened = (x - mean) @ axes
            m = len(x)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [f.split()[0] for f in OUTPUT.split(", ")],
            )

    return rows.mapInArrow(project, OUTPUT)
