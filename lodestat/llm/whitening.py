"""Whitening of embeddings by principal components from a block Jacobi-Davidson iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import written

SCALE, OFFSET = 1024, 100_000
EPS = float(np.finfo(float).eps)


def lattice_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x: the rows that can be used, every entry c as the long floor(1024 c) + 100000.

    A null vector, one with a null or non-finite entry or with one of 2^21 or more to either side, goes. Vectors of several lengths are
    not of one space: those of the most common length stay (of equally common ones the longest); empty vectors go. Null
    and repeated ids and repeated rows stay rows of their own.
    """
    fine = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float(1 << 21))  # noqa: E731  NaN counts as larger than any number
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", fine)).select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE) + OFFSET).alias("x"))
    rows = written(rows, "lattice")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _summed(rows: DataFrame, partial: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of ``partial`` (of a batch's matrix), flat. Tasks send their sums; a result has the length of one of these."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch)).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(total)), "value": total})

    parts = rows.select("x").mapInArrow(sums, f"at long, value {kind}")
    totals = parts.groupBy("at").agg(F.sum("value").alias("total")).collect()
    return np.array([r["total"] for r in sorted(totals, key=lambda r: r["at"])])


class Covariance:
    """The covariance (divisor n) of ``rows`` as a product: it is never formed, on the driver or elsewhere."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.n = rows.count()
        self.sums = _summed(rows, lambda x: x.sum(axis=0), "long")
        self.mean = self.sums / max(self.n, 1)
        self.dim = len(self.sums)
        self.trace = float(_summed(rows, self._squares(), "double")[0] / self.n) if self.n else 0.0

    def _squares(self):
        mean = self.mean
        return lambda x: np.array([((x - mean) ** 2).sum()])

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``block``: one pass over the rows for all of them."""
        mean = self.mean

        def partial(x: np.ndarray) -> np.ndarray:
            y = x - mean
            return y.T @ (y @ block)

        return _summed(self.rows, partial, "double").reshape(block.shape) / self.n


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: np.ndarray) -> np.ndarray:
    """Column by column, MINRES for ``apply(x) = right``; the columns go in step, so that they share the products.

    A column stops changing at its ``tolerance`` (relative); the loop ends when all have, or after ``steps`` products.
    """
    size = np.linalg.norm(right, axis=0)
    live = size > 0
    safe = lambda z: np.where(z == 0, 1.0, z)
    x = np.zeros_like(right)
    v_old, v, beta = np.zeros_like(right), right / safe(size), np.zeros_like(size)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    c_old, c, s_old, s = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
    eta = size.copy()
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1, r2, r3 = np.hypot(delta, beta_next), s * alpha + c_old * c * beta, s_old * beta
        w_old, w = w, (v - r3 * w_old - r2 * w) / safe(r1)
        c_old, c, s_old, s = c, delta / safe(r1), s, beta_next / safe(r1)
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live = live & (np.abs(eta) > tolerance * size) & (beta_next > EPS * safe(size))
        if not live.any():
            break
        v_old, v, beta = v, p / safe(beta_next), beta_next
    return x


def _orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """What is new in ``block`` beyond ``against``, as orthonormal columns; directions lost to rounding go."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        for basis in against:
            block = block - basis @ (basis.T @ block)
        left, kept, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, kept > 1e-10]
    return block


@dataclass
class Components:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    rounds: int
    products: int


def jacobi_davidson(a: Covariance, wanted: int = 8, block: int = 8, most_basis: int = 48, inner: int = 24, seed: int = 3, most_rounds: int = 200) -> Components:
    """The ``wanted`` largest eigenpairs of ``a``, until all residuals are down to rounding.

    A round does Rayleigh-Ritz in the searched subspace, locks the leading pairs whose residual |A u - t u| is at most
    16 eps times the largest value times the root of the dimension, and for the next ``block`` pairs solves the correction equations
    (I - Q Q')(A - t)(I - Q Q') z = -r by inner MINRES, Q being the locked vectors and all pairs under correction. The solutions widen the
    subspace; beyond ``most_basis`` columns it is restarted from its leading pairs. Numbers on the driver: a few
    columns per basis vector; products with ``a`` are distributed. Raises when ``most_rounds`` don't suffice.
    """
    wanted = min(wanted, a.dim)
    draw = np.random.default_rng(seed)
    products = 0

    def times(x: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1
        return a.times(x)

    basis = _orthonormal(draw.standard_normal((a.dim, min(a.dim, wanted + block))), [])
    image = times(basis)
    locked, values, residuals = np.zeros((a.dim, 0)), [], []
    for rounds in range(1, most_rounds + 1):
        small = basis.T @ image
        theta, mix = np.linalg.eigh((small + small.T) / 2)
        theta, mix = theta[::-1], mix[:, ::-1]
        basis, image = basis @ mix, image @ mix
        error = np.linalg.norm(image - basis * theta, axis=0)
        bound = 16 * EPS * np.sqrt(a.dim) * max([*values, theta[0]], default=0.0)
        done = 0
        while done < len(theta) and len(values) + done < wanted and error[done] <= bound:
            done += 1
        locked = np.hstack([locked, basis[:, :done]])
        values += list(theta[:done])
        residuals += list(error[:done])
        basis, image, theta, error = basis[:, done:], image[:, done:], theta[done:], error[done:]
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return Components(np.array(values)[order], locked[:, order], np.array(residuals)[order], rounds, products)
        if basis.shape[1] + block > max(most_basis, wanted + 2 * block):
            keep = wanted - len(values) + block
            basis, image, theta, error = basis[:, :keep], image[:, :keep], theta[:keep], error[:keep]
        open_pairs = min(block, wanted - len(values) + 2, basis.shape[1])
        u, t = basis[:, :open_pairs], theta[:open_pairs]
        away = np.hstack([locked, u])
        project = lambda z: z - away @ (away.T @ z)
        tolerance = np.full(open_pairs, 2.0 ** -min(rounds + 2, 30))
        wider = minres(lambda z: project(times(project(z)) - z * t), project(basis[:, :open_pairs] * t - image[:, :open_pairs]), min(inner, a.dim), tolerance)
        fresh = _orthonormal(wider, [locked, basis])
        if not fresh.shape[1]:  # nothing new: any direction serves
            fresh = _orthonormal(draw.standard_normal((a.dim, block)), [locked, basis])
        if fresh.shape[1]:
            basis, image = np.hstack([basis, fresh]), np.hstack([image, times(fresh)])
        else:  # the subspace is the whole space; only rounding is left
            image = times(basis)
    raise RuntimeError(f"{len(values)} of {wanted} pairs after {most_rounds} rounds")


def whiten(embeddings: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding", **settings) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components whose value is 0 but for rounding don't exist: equal vectors, or fewer vectors than dimensions, can have
    fewer than ``components``; one vector alone has none, and an empty table gives no row. Equal values may come in any rotation. A deviation beyond a long is null.
    """
    spark = embeddings.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = lattice_vectors(embeddings, key, vector)
    a = Covariance(rows)
    if not a.trace:
        return spark.createDataFrame([], schema)
    found = jacobi_davidson(a, components, **settings)
    real = found.values > 64 * EPS * a.dim * found.values[0]
    axes, explained = found.vectors[:, real] / np.sqrt(found.values[real]), found.values[real] / a.trace
    n, sums, mean, k = a.n, a.sums, a.mean, int(real.sum())

    def moments(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ axes
        return np.vstack([w.T @ w, w.sum(axis=0)])

    second = _summed(rows, moments, "double").reshape(k + 1, k) / n
    error = float(np.abs(second[:k] - np.outer(second[k], second[k]) - np.eye(k)).max())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            away = x * n - sums
            if float(np.abs(away).max()) ** 2 * x.shape[1] < 2.0**62:
                deviation = (away * away).sum(axis=1).tolist()
            else:
                exact = [sum(int(z) ** 2 for z in row) for row in away]
                deviation = [z if z < 2**63 else None for z in exact]
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(count), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, n)),
                    pa.array([z for z in deviation for _ in range(k)], pa.int64()),
                    pa.array(((x - mean) @ axes).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(emit, schema.replace("vec_id long", f"vec_id {rows.schema['vec_id'].dataType.simpleString()}"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
