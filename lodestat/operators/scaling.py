"""Scalers and linear reductions. Fitted state is one row of statistics or a small matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.encoding import levels
from lodestat.operators.quantiles import quantile_values

KINDS = ("zscore", "minmax", "robust", "maxabs")


@dataclass(frozen=True)
class Scaler:
    """(x - centre) / spread per column, fitted on one table and applied to any."""

    centre: dict[str, float]
    spread: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.centre[c]) / (self.spread[c] or 1.0) for c in self.centre})


def fit_scaler(train: DataFrame, columns: Sequence[str], kind: str) -> Scaler:
    if kind == "robust":
        q = quantile_values(train, columns, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
        return Scaler({c: q[f"{c}_q2"] for c in columns}, {c: q[f"{c}_q3"] - q[f"{c}_q1"] for c in columns})
    measures = {
        "zscore": (F.avg, F.stddev_pop),
        "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
        "maxabs": (lambda c: F.lit(0.0), lambda c: F.max(F.abs(c))),
    }
    if kind not in measures:
        raise ValueError(f"unknown scaler: {kind}")
    centre, spread = measures[kind]
    row = train.agg(*[centre(F.col(c)).alias(f"c_{c}") for c in columns], *[spread(F.col(c)).alias(f"s_{c}") for c in columns]).first()
    return Scaler({c: row[f"c_{c}"] for c in columns}, {c: row[f"s_{c}"] for c in columns})


def unit_rows(vector):
    """A vector column scaled to length 1 (a zero vector stays)."""
    v = F.transform(vector, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v)


def covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, covariance) of all column pairs from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("covariance")) for i, (a, b) in enumerate(pairs)])))


@dataclass(frozen=True)
class Components:
    columns: list[str]
    means: np.ndarray
    variances: np.ndarray
    loadings: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        return self.variances / self.variances.sum()

    def count_for(self, share: float) -> int:
        """Fewest components that explain the share."""
        return int(np.searchsorted(np.cumsum(self.shares), share - 1e-12) + 1)

    def scores(self, df: DataFrame, count: int) -> DataFrame:
        made = {}
        for k in range(count):
            terms = [(F.col(c) - float(m)) * float(w) for c, m, w in zip(self.columns, self.means, self.loadings[:, k])]
            made[f"pc{k + 1}"] = sum(terms[1:], terms[0])
        return df.withColumns(made)

    def weak_columns(self, quantile: float = 0.1) -> list[str]:
        """Columns whose summed absolute loading is in the lowest part."""
        weight = np.abs(self.loadings).sum(axis=1)
        return [c for c, w in zip(self.columns, weight) if w <= np.quantile(weight, quantile)]


def fit_pca(df: DataFrame, columns: Sequence[str]) -> Components:
    """Principal components of the covariance matrix; p (p + 1) / 2 numbers reach the driver."""
    columns = list(columns)
    place = {c: i for i, c in enumerate(columns)}
    matrix = np.zeros((len(columns), len(columns)))
    for r in covariance(df, columns).collect():
        matrix[place[r["a"]], place[r["b"]]] = matrix[place[r["b"]], place[r["a"]]] = r["covariance"]
    means = np.array(list(df.agg(*[F.avg(c) for c in columns]).first()), dtype=float)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(columns))])
    return Components(columns, means, np.maximum(values[order], 0), vectors * signs)


def components_table(df: DataFrame, c: Components) -> DataFrame:
    rows = [
        (k + 1, float(c.variances[k]), float(c.shares[k]), name, float(c.loadings[i, k]))
        for k in range(len(c.variances))
        for i, name in enumerate(c.columns)
    ]
    return df.sparkSession.createDataFrame(rows, "component int, variance double, share double, column string, loading double")


def vector_gram(df: DataFrame, vector: str) -> np.ndarray:
    """Sum of v v' over all rows. Each task adds up its own rows; one short matrix per task is exchanged."""

    def partial(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                block = np.stack(pdf[vector].to_numpy()).astype(float)
                total = block.T @ block if total is None else total + block.T @ block
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    sums = df.select(vector).mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = sums.collect()  # p x p numbers
    out = np.zeros((max(r["i"] for r in rows) + 1,) * 2)
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
    return out


def truncated_svd(df: DataFrame, vector: str, share: float = 0.9) -> DataFrame:
    """Singular values with the share of squares they explain, as many as reach the wanted share."""
    values = np.sort(np.linalg.eigvalsh(vector_gram(df, vector)))[::-1].clip(min=0)
    shares = values / values.sum()
    keep = int(np.searchsorted(np.cumsum(shares), share) + 1)
    rows = [(k + 1, float(values[k] ** 0.5), float(shares[k]), float(shares[: k + 1].sum())) for k in range(keep)]
    return df.sparkSession.createDataFrame(rows, "component int, singular_value double, share double, cumulative double")


def fit_famd(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[DataFrame, Components]:
    """Mixed data: unit-variance numerics and indicators over the root of their share, then components."""
    scaled = fit_scaler(df, numeric, "zscore").apply(df)
    made, flags = [], {}
    for c in categorical:
        for v in levels(df, c):
            flags[f"{c}_{v}"] = (F.col(c) == v).cast("double")
    shares = df.agg(*[F.avg(f).alias(n) for n, f in flags.items()]).first()
    for n, f in flags.items():
        scaled = scaled.withColumn(n, f / float(shares[n]) ** 0.5)
        made.append(n)
    return scaled, fit_pca(scaled, [*numeric, *made])
