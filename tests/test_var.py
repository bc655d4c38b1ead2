import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import series as Se

START = datetime.datetime(2024, 1, 1)


def made_series(n, seed, order=2):
    draw = np.random.default_rng(seed)
    push = [np.array([[0.5, 0.2], [-0.3, 0.4]]), np.array([[0.2, 0.0], [0.1, -0.3]])][:order]
    y = [draw.standard_normal(2) for _ in range(order)]
    for i in range(n - order):
        day = START + datetime.timedelta(days=len(y))
        y.append(5 + 0.01 * len(y) + 3 * (day.weekday() == 6) + sum(a @ y[-k - 1] for k, a in enumerate(push)) + 0.5 * draw.standard_normal(2))
    return np.array(y)


def plain_var(y, lags, horizon, trend, order=None):
    """Least squares on stacked rows, BIC over the same rows, and the recursion."""
    days = [START + datetime.timedelta(days=i) for i in range(len(y) + horizon)]
    fixed = lambda i: [*{"n": [], "c": [1.0], "ct": [1.0, i]}[trend], float(days[i].weekday() == 6)]
    best = None
    for p in range(1, lags + 1) if order is None else [order]:
        x = np.array([[*fixed(i), *np.concatenate([y[i - k] for k in range(1, p + 1)])] for i in range(lags, len(y))])
        beta, *_ = np.linalg.lstsq(x, y[lags:], rcond=None)
        left = y[lags:] - x @ beta
        score = np.linalg.slogdet(left.T @ left / len(x))[1] + math.log(len(x)) / len(x) * x.shape[1] * y.shape[1]
        if best is None or score < best[0]:
            best = score, p, beta
    _, p, beta = best
    path = list(y)
    for i in range(len(y), len(y) + horizon):
        path.append(np.array([*fixed(i), *np.concatenate([path[i - k] for k in range(1, p + 1)])]) @ beta)
    return p, np.array(path[len(y) :])


@pytest.mark.parametrize("trend, order", [("c", None), ("ct", None), ("n", 1), ("c", 3)])
def test_var_against_stacked_least_squares(spark, trend, order):
    series = {"a": made_series(150, 1), "b": made_series(90, 2, 1), None: made_series(60, 3)}
    rows = [(k, START + datetime.timedelta(days=i), *map(float, v)) for k, y in series.items() for i, v in enumerate(y)]
    table = spark.createDataFrame(rows, "key string, day timestamp_ntz, u double, v double")
    found = Se.vector_autoregression(table, "day", ["u", "v"], 4, 5, ["key"], {"sunday": lambda d: F.dayofweek(d) == 1}, trend, order).collect()
    assert len(found) == 3 * 5 * 2
    for key, y in series.items():
        p, want = plain_var(y, 4, 5, trend, order)
        for r in (r for r in found if r["key"] == key):
            assert r["lags"] == p and r["day"] == START + datetime.timedelta(days=len(y) - 1 + r["h"])
            assert math.isclose(r["forecast"], want[r["h"] - 1]["uv".index(r["variable"])], rel_tol=1e-7)


def test_orders_are_told_apart(spark):
    """A series of order 2 gets two lags, white noise one."""
    noise = np.random.default_rng(8).standard_normal((300, 2))
    rows = [(k, START + datetime.timedelta(days=i), *map(float, v)) for k, y in (("two", made_series(300, 5)), ("noise", noise)) for i, v in enumerate(y)]
    table = spark.createDataFrame(rows, "key string, day timestamp_ntz, u double, v double")
    sunday = {"sunday": lambda d: F.dayofweek(d) == 1}
    assert {(r["key"], r["lags"]) for r in Se.vector_autoregression(table, "day", ["u", "v"], 6, 1, ["key"], sunday, "ct").collect()} == {("two", 2), ("noise", 1)}


def test_short_and_broken_series(spark):
    rows = [("short", START, 1.0, 2.0), ("short", START + datetime.timedelta(days=1), 1.0, 2.0)]
    rows += [("hole", START + datetime.timedelta(days=i), None if i == 29 else float(i % 7), float(i * i % 11)) for i in range(30)]
    rows += [("flat", START + datetime.timedelta(days=i), 4.0, float(i * i % 11)) for i in range(30)]
    table = spark.createDataFrame(rows, "key string, day timestamp_ntz, u double, v double")
    found = {(r["key"], r["variable"], r["h"]): r["forecast"] for r in Se.vector_autoregression(table, "day", ["u", "v"], 1, 2, ["key"]).collect()}
    assert len(found) == 12 and found["short", "u", 1] is None and found["hole", "v", 2] is None
    assert abs(found["flat", "u", 2] - 4) < 1e-9
    assert Se.vector_autoregression(table.limit(0), "day", ["u", "v"], 1, 2, ["key"]).collect() == []
