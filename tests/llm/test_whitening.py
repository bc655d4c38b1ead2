import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors):
    """x as whole numbers, the covariance's values and vectors by falling value."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], dtype=np.int64)
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / len(x))
    return x, values[::-1], axes[:, ::-1]


def check(rows, ids, vectors, components=8):
    x, values, axes = plain(vectors)
    n, k = len(x), int((values[:components] > 1e-11 * values[0]).sum())
    assert len(rows) == n * k
    found = defaultdict(dict)
    for r in rows:
        found[r["vec_id"]][r["component"]] = r
    sums = [int(s) for s in x.sum(axis=0)]
    for i, v in zip(ids, x, strict=True):
        assert sorted(found[i]) == list(range(1, k + 1))
        assert {r["deviation"] for r in found[i].values()} == {sum((n * int(c) - s) ** 2 for c, s in zip(v, sums, strict=True))}
        assert {r["n"] for r in found[i].values()} == {n}
    for j in range(k):
        assert all(abs(r["explained"] - values[j] / values.sum()) < 1e-10 for r in (found[i][j + 1] for i in ids))
        got = np.array([found[i][j + 1]["whitened"] for i in ids])
        want = (x - x.mean(axis=0)) @ axes[:, j] / np.sqrt(values[j])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10


def test_small_table_against_dense_eigenvectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    usable = [(r["vec_id"], r["embedding"]) for r in table.collect() if r["embedding"] is not None]
    rows = w.op13_whitening(spark, "/root/testdata/sf0.001").collect()
    check(rows, [i for i, _ in usable], [v for _, v in usable])


def random_vectors(n, d, seed=1):
    draw = np.random.default_rng(seed)
    return (draw.standard_normal((n, d)) * np.linspace(1, 3, d)).astype(np.float32).tolist()


def test_odd_rows_go(spark):
    vectors = random_vectors(40, 5)
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    odd = [(100, None, 1), (101, [], 1), (102, [1.0, None, 0.0, 0.0, 0.0], 1), (103, [math.nan] * 5, 1), (104, [0.0, math.inf, 0.0, 0.0, 0.0], 1)]
    odd += [(105, [1.0, 2.0], 1), (106, [3.0e38] * 5, None), (107, [-math.inf] * 5, 1)]
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumns({c: F.lit(0) for c in ("x", "n", "component", "at", "value", "whitened")}).repartition(3)
    check(w.whiten(table, components=3).collect(), list(range(40)), vectors, 3)


def test_hot_vector_and_repeated_rows(spark):
    """Half of the rows hold one vector; null and repeated ids stay rows of their own."""
    vectors = random_vectors(60, 12)
    vectors += [vectors[0]] * 60
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    check(w.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), list(range(120)), vectors)
    table = spark.createDataFrame([*rows, (None, vectors[1], 1), (7, vectors[7], 1), (7, vectors[7], 1)], SCHEMA)
    counts = {r["vec_id"]: r["count"] for r in w.whiten(table).groupBy("vec_id").count().collect()}
    assert counts[None] == 8 and counts[7] == 24 and counts[8] == 8


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_spread_gives_no_component(spark, vectors):
    out = w.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_vectors_than_dimensions(spark):
    vectors = random_vectors(4, 30)
    check(w.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect(), list(range(4)), vectors)


def test_equal_values(spark):
    """A cross of unit vectors: all values equal, any rotation will do."""
    vectors = [[s * (i == j) for j in range(6)] for i in range(6) for s in (1.0, -1.0)]
    rows = w.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA), components=6).collect()
    assert len(rows) == 72 and max(r["identity_error"] for r in rows) < 1e-10
    assert all(abs(r["explained"] - 1 / 6) < 1e-12 for r in rows)


def test_deviation_is_exact_or_null(spark):
    vectors = [[2.0**16, 0.0], [-(2.0**16), 0.0], [0.0, 2.0**15]] * 10
    check(w.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect(), list(range(30)), vectors)
    vectors = [[2.0**16, 0.0], [-(2.0**16), 0.0], [0.0, 2.0**15]] * 40
    rows = w.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert {r["deviation"] is None for r in rows if r["vec_id"] % 3 < 2} == {True}
    assert {r["deviation"] is None for r in rows if r["vec_id"] % 3 == 2} == {False}


class Dense:
    def __init__(self, matrix):
        self.matrix, self.dim, self.trace = matrix, len(matrix), float(np.trace(matrix))

    def times(self, block):
        return self.matrix @ block


@pytest.mark.parametrize("spectrum", ["falling", "flat", "clustered", "short"])
def test_jacobi_davidson_on_spectra(spectrum):
    draw = np.random.default_rng(5)
    d = 300
    values = {
        "falling": 1e4 / np.arange(1, d + 1) ** 2,
        "flat": np.linspace(1, 1.2, d),
        "clustered": np.r_[5 + 1e-7 * np.arange(6), np.linspace(0, 1, d - 6)],
        "short": np.r_[np.arange(3.0, 0, -1), np.zeros(d - 3)],
    }[spectrum]
    axes, _ = np.linalg.qr(draw.standard_normal((d, d)))
    matrix = axes * values @ axes.T
    found = w.jacobi_davidson(Dense((matrix + matrix.T) / 2), wanted=8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(found.values - want).max() < 1e-12 * want[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-12 * want[0]


def test_minres_solves_indefinite_systems():
    draw = np.random.default_rng(6)
    axes, _ = np.linalg.qr(draw.standard_normal((30, 30)))
    matrix = axes * np.r_[-np.arange(1.0, 11), np.arange(1.0, 21)] @ axes.T
    right = np.c_[draw.standard_normal((30, 3)), np.zeros(30)]
    x = w.minres(lambda z: matrix @ z, right, 60, np.full(4, 1e-12))
    assert np.abs(matrix @ x - right).max() < 1e-9
