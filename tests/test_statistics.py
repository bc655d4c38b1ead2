"""Published and hand-computed numbers for the statistical operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestat.functions import special as sp
from lodestat.operators import drift, evaluation, hypothesis_tests as H, learners as L, ranking as R, series as S


def test_special_functions():
    assert sp.normal_quantile(0.975) == pytest.approx(1.959963984540054)
    assert sp.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert sp.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05)
    assert sp.f_tail(4.964602743730711, 1, 10) == pytest.approx(0.05)
    assert sp.beta_quantile(0.5, 3, 3) == pytest.approx(0.5)
    assert sp.digamma(1.0) == pytest.approx(-0.5772156649015329)
    # I1(2) / I0(2)
    assert sp.kappa_of_resultant(np.array([0.697774657964008]))[0] == pytest.approx(2.0, rel=1e-6)


def test_normal_quantile_column(spark):
    p = [1e-9, 1e-4, 0.01, 0.2, 0.5, 0.77, 0.999, 1 - 1e-7]
    got = sp.with_normal_quantile(spark.createDataFrame([(x,) for x in p], "p double"), "p", "z").collect()
    for row in got:
        assert row["z"] == pytest.approx(sp.normal_quantile(row["p"]), abs=1e-8)


def test_brunner_munzel_clinical_example(spark):
    # fixed values: pain scores after two treatments, published with the test by Brunner and Munzel (Biometrical Journal 42, 2000)
    treated = [1, 2, 1, 1, 1, 1, 1, 1, 1, 1, 2, 4, 1, 1]
    control = [3, 3, 4, 3, 1, 2, 3, 1, 1, 5, 4]
    rows = [(float(v), False) for v in treated] + [(float(v), True) for v in control]
    got = H.brunner_munzel(spark.createDataFrame(rows, "v double, second boolean"), "v", F.col("second")).first()
    assert got["statistic"] == pytest.approx(3.1374674823029505)
    assert got["df"] == pytest.approx(17.682841979481545)
    assert got["p_value"] == pytest.approx(0.0057862086661515377)
    assert got["effect"] == pytest.approx(0.788961038961039)


def test_ordinal_sample_size(spark):
    """The effect by listing all pairs of categories; the total from the rank test's variance with ties."""
    control, treated = [0.15, 0.25, 0.35, 0.25], [0.4, 0.3, 0.2, 0.1]
    shares = spark.createDataFrame(list(zip(range(4), control, treated)), "o int, c double, x double")
    got = H.ordinal_sample_size(shares, "o", "c", "x", 0.5).first()
    wins = sum(p * q * (1.0 if i > j else 0.5 if i == j else 0.0) for i, p in enumerate(control) for j, q in enumerate(treated))
    assert got["effect"] == pytest.approx(wins)
    pooled = [(p + q) / 2 for p, q in zip(control, treated)]
    spread = (1 - sum(p**3 for p in pooled)) / 3
    reach = sp.normal_quantile(0.975) + sp.normal_quantile(0.8)
    assert got["n_total"] == pytest.approx(spread * (reach / (wins - 0.5)) ** 2)


@pytest.mark.parametrize(
    "scores, labels, want",
    [([1, 2, 3, 4], [0, 0, 1, 1], 1.0), ([1, 2, 3, 4], [1, 1, 0, 0], -1.0), ([2, 2, 2, 2], [0, 1, 0, 1], 0.0), ([1, 2, 3], [1, 1, 1], 0.0)],
)
def test_somers_d_edges(spark, scores, labels, want):
    df = spark.createDataFrame([(float(s), bool(b)) for s, b in zip(scores, labels)], "s double, y boolean")
    assert R.somers_d(df, "s", F.col("y")).first()[0] == pytest.approx(want)


def test_somers_d_is_twice_auc_less_one(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"s": rng.integers(0, 30, 500).astype(float), "y": rng.random(500) < 0.4, "w": rng.random(500)})
    df = spark.createDataFrame(pdf)
    d = R.somers_d(df, "s", F.col("y"), F.col("w")).first()[0]
    a = R.auc(df, "s", F.col("y"), F.col("w")).first()["auc"]
    assert d == pytest.approx(2 * a - 1)
    same = R.somers_d(df, "s", F.col("y"), F.lit(1.0)).first()[0]
    assert same == pytest.approx(R.somers_d(df, "s", F.col("y")).first()[0])


def test_psi_grows_with_the_shift(spark):
    rng = np.random.default_rng(11)
    base = spark.createDataFrame(pd.DataFrame({"v": rng.normal(0, 1, 3000)}))
    values = []
    for shift in (0.0, 0.5, 1.0, 1.5):
        moved = spark.createDataFrame(pd.DataFrame({"v": rng.normal(shift, 1, 3000)}))
        values.append(drift.psi(base, moved, "v").first()["psi"])
    assert values == sorted(values)
    assert values[0] < 0.05


def _psi(base, now, edges, closed=False, eps=1e-6):
    count = lambda v: np.histogram(v[(v >= edges[0]) & (v <= edges[-1])] if closed else np.clip(v, edges[0], edges[-1]), edges)[0].astype(float)
    q, p = (np.where(c == 0, eps, c / c.sum()) for c in (count(base), count(now)))
    q, p = q / q.sum(), p / p.sum()
    return ((p - q) * np.log(p / q)).sum()


def test_psi_bins_of_every_kind(spark):
    rng = np.random.default_rng(12)
    a, b = rng.normal(0, 1, 400), rng.normal(0.4, 1.2, 300)
    base, now = (spark.createDataFrame([(float(x),) for x in v], "v double") for v in (a, b))
    edges = [-1.5, -0.5, 0.1, 0.9, 2.5]
    assert drift.psi(base, now, "v", edges).first()["psi"] == pytest.approx(_psi(a, b, edges))
    assert drift.psi(base, now, "v", edges, open_ended=False).first()["psi"] == pytest.approx(_psi(a, b, edges, closed=True))
    assert drift.psi(base, now, "v", 7).first()["psi"] == pytest.approx(_psi(a, b, np.linspace(a.min(), a.max(), 8)))
    assert drift.psi(base, now, "v", 6, data_range=(-1.0, 1.0)).first()["psi"] == pytest.approx(_psi(a, b, np.linspace(-1, 1, 7)))
    assert drift.psi(base, now, "v", 4000).first().asDict() == {"psi": pytest.approx(_psi(a, b, np.linspace(a.min(), a.max(), 4001))), "bins": 4000}
    same = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert drift.psi(same, same, "v").first()["psi"] == pytest.approx(0)
    none = spark.createDataFrame([], "v double")
    for bad in ([1.0, 1.0, 2.0], [1.0], 0, "unheard of"):
        with pytest.raises(ValueError):
            drift.psi(base, now, "v", bad)
    for x, y in ((none, now), (base, none)):
        with pytest.raises(ValueError):
            drift.psi(x, y, "v", 5)


def test_wsri_refuses_uncovered_bins(spark):
    base = spark.createDataFrame([(float(i), i % 2 == 0) for i in range(20)], "s double, y boolean")
    low = base.filter("s < 5")
    assert drift.wsri(base, base, "s", F.col("y"), 4).first()["wsri"] == pytest.approx(1.0)
    with pytest.raises(ValueError, match="occur in monitoring"):
        drift.bin_weights(low, base, "s", [2.0, 10.0])


def test_conformal_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in (3, 1, 4, 1, 5)], "v double")
    got = evaluation.conformal_quantiles(df, {"a": F.col("v")}, 0.2).first()["quantile"]
    assert got == 5.0
    assert evaluation.conformal_quantiles(df, {"a": F.col("v")}, 0.05).first()["quantile"] == math.inf


def test_logistic_cost_and_gradient(spark):
    rows = [(0.2, -1.0, 0), (1.4, 0.3, 1), (-0.7, 2.2, 1), (0.9, 0.9, 0)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    assert L.cost_and_gradient(df, F.col("y"), ["a", "b"], [0.0, 0.0, 0.0], logistic=True).first()["cost"] == pytest.approx(math.log(2))
    beta = np.array([0.3, -0.8, 0.5])
    cost = lambda w: np.mean([math.log1p(math.exp(-z if y else z)) for a, b, y in rows for z in [w[0] + w[1] * a + w[2] * b]])
    got = L.cost_and_gradient(df, F.col("y"), ["a", "b"], list(beta), logistic=True).first()
    assert got["cost"] == pytest.approx(cost(beta))
    for i, name in enumerate(["d_intercept", "d_a", "d_b"]):
        step = np.eye(3)[i] * 1e-6
        assert got[name] == pytest.approx((cost(beta + step) - cost(beta - step)) / 2e-6, abs=1e-6)


def test_logit_recovers_numpy_solution(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=1500)
    y = rng.random(1500) < 1 / (1 + np.exp(-(0.3 + 0.8 * x)))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    fit = H.logit_regression(df, F.col("y"), ["x"])
    assert fit["x"][0] == pytest.approx(0.8, abs=0.2)
    assert fit["intercept"][0] == pytest.approx(0.3, abs=0.2)


def test_partial_autocorrelation_of_first_order_process(spark):
    rng = np.random.default_rng(4)
    v = np.zeros(600)
    for i in range(1, 600):
        v[i] = 0.7 * v[i - 1] + rng.normal()
    df = spark.createDataFrame(pd.DataFrame({"t": range(600), "v": v}))
    got = {r["lag"]: r["pacf"] for r in S.partial_autocorrelation(df, "t", "v", 3).collect()}
    assert got[1] == pytest.approx(0.7, abs=0.1)
    assert abs(got[2]) < 0.12 and abs(got[3]) < 0.12


def test_fligner_killeen_sees_unequal_spread(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"v": np.concatenate([rng.normal(0, 1, 300), rng.normal(0, 3, 300)]), "g": ["a"] * 300 + ["b"] * 300})
    assert H.fligner_killeen(spark.createDataFrame(pdf), "v", "g").first()["p_value"] < 1e-6


def test_ranking_evaluator(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.35, 0), (0.8, 1)], "s double, y int")
    assert R.RankingEvaluator("s", "y").evaluate(df) == pytest.approx(1.0)
    assert R.RankingEvaluator("s", "y", "auc").evaluate(df) == pytest.approx(1.0)


@pytest.mark.parametrize("period", [4, 12, 5, 52.18])
def test_decompose_finds_the_season(spark, period):
    m = int(period)
    season = np.sin(np.arange(m) * 2 * np.pi / m)
    season -= season.mean()
    n = 6 * m
    values = [2.0 * i + season[i % m] for i in range(n)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "t_ long, v double").withColumnRenamed("t_", "day")
    rows = S.decompose(df, "day", "v", period).orderBy("day").collect()
    for i, r in enumerate(rows):
        if m // 2 <= i < n - m // 2:
            assert r["trend"] == pytest.approx(2.0 * i) and r["residual"] == pytest.approx(0, abs=1e-9)
        else:
            assert r["trend"] is None
        assert r["seasonal"] == pytest.approx(season[i % m])


def test_weights_of_the_bootstrap_are_poisson(spark):
    from lodestat.operators.aggregates import poisson_one

    rows = spark.range(200_000).select(poisson_one((F.col("id") + 0.5) / 200_000).alias("k")).groupBy("k").count().collect()
    got = {r["k"]: r["count"] / 200_000 for r in rows}
    for k in range(7):
        assert got[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=1e-5)


def test_learners_without_sql(spark):
    """Principal components are orthonormal and hold the variance; elimination keeps what matters."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 2)) @ np.array([[3.0, 1.0, 0.5], [0.2, 1.0, -2.0]]) + rng.normal(scale=0.1, size=(400, 3))
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=(x[:, 0] > 0).astype(int), noise=rng.normal(size=400))
    df = spark.createDataFrame(pdf)
    ranks = {r["feature"]: r["ranking"] for r in L.eliminate_features(df, "y", ["a", "noise", "c"], 1).collect()}
    assert ranks["a"] == 1
    line = spark.createDataFrame(pd.DataFrame({"x": np.arange(60.0), "z": 1 + 2 * np.arange(60.0) + np.where(np.arange(60) % 20 == 7, 500.0, rng.normal(0, 0.1, 60))}))
    intercept, slope = L.huber_line(line, "z", "x")
    assert slope == pytest.approx(2, abs=0.02) and intercept == pytest.approx(1, abs=0.5)
