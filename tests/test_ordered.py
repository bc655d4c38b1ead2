"""The sliced windows against pandas, with a key and a value that hold most of the rows."""

import numpy as np
import pandas as pd
import pytest

from lodestat.operators import ordered as O
from lodestat.operators.aggregates import kendall_tau_b
from lodestat.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 4000
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "key": np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abcdef"), n)),
            "v": np.where(rng.random(n) < 0.4, 5.0, rng.normal(0, 10, n).round(1)),
            "m": rng.integers(0, 9, n),
        }
    )


def test_running_totals(spark, frame):
    folded = frame.groupby(["key", "v"], as_index=False)["m"].sum()
    got = O.running_totals(spark.createDataFrame(folded), "v", ["m"], ["key"]).toPandas()
    want = folded.sort_values("v")
    want["cum_m"] = want.groupby("key")["m"].cumsum()
    both = got.merge(want, on=["key", "v"])
    assert len(both) == len(folded)
    assert (both["cum_m_x"] == both["cum_m_y"]).all()


def test_running_totals_over_text(spark):
    words = pd.DataFrame({"w": [f"Brand#{i:04d}" for i in range(500)], "one": 1})
    got = O.running_totals(spark.createDataFrame(words), "w", ["one"]).toPandas().sort_values("w")
    assert got["cum_one"].tolist() == list(range(1, 501))


@pytest.mark.parametrize("descending", [False, True])
def test_row_numbers(spark, frame, descending):
    got = O.row_numbers(spark.createDataFrame(frame), "v", "id", ["key"], descending=descending).toPandas()
    want = frame.sort_values(["v", "id"], ascending=[not descending, True])
    want["row_number"] = want.groupby("key").cumcount() + 1
    both = got.merge(want, on="id")
    assert (both["row_number_x"] == both["row_number_y"]).all()


def test_previous_row_and_carry_forward(spark, frame):
    holes = frame.assign(v=frame["v"].where(frame["id"] % 3 != 0))
    df = spark.createDataFrame(holes.astype({"v": object}).where(holes.notna(), None), "id long, key string, v double, m long")
    prev = O.previous_row(df, "id", {"before": "m"}, ["key"]).toPandas().sort_values("id")
    want = holes.sort_values("id").groupby("key")["m"].shift(1)
    assert np.allclose(prev["before"].astype(float), want.astype(float), equal_nan=True)
    filled = O.carry_forward(df, "id", ["v"], ["key"]).toPandas().sort_values("id")
    assert np.allclose(filled["v"].astype(float), holes.groupby("key")["v"].ffill(), equal_nan=True)


def test_hash_row_numbers_number_every_class(spark, frame):
    got = O.hash_row_numbers(spark.createDataFrame(frame), ["id"], ["key"], name="i").toPandas()
    for _, part in got.groupby("key"):
        assert sorted(part["i"]) == list(range(1, len(part) + 1))


def test_exact_quantiles(spark, frame):
    probabilities = {f"p{int(p * 100)}": p for p in (0.0, 0.05, 0.25, 0.5, 0.9, 1.0)}
    got = exact_quantiles(spark.createDataFrame(frame), ["v"], probabilities, ["key"]).toPandas().set_index("key")
    for key, part in frame.groupby("key"):
        for name, p in probabilities.items():
            assert got.loc[key, name] == pytest.approx(np.quantile(part["v"], p))


def test_kendall_equals_pairs(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, 200), rng.integers(0, 13, 200)
    got = kendall_tau_b(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "x", "y").first()
    s = np.sign(x[:, None] - x[None]) * np.sign(y[:, None] - y[None])
    upper = np.triu(s, 1)
    c, d = (upper > 0).sum(), (upper < 0).sum()
    pairs = 200 * 199 / 2
    tx = sum(m * (m - 1) / 2 for m in np.bincount(x))
    ty = sum(m * (m - 1) / 2 for m in np.bincount(y))
    assert (got["concordant"], got["discordant"]) == (c, d)
    assert got["tau_b"] == pytest.approx((c - d) / np.sqrt((pairs - tx) * (pairs - ty)))


def test_text_outlier_and_hot_values(spark):
    """One odd text, a prefix that all others share, and a value that most rows hold."""
    words = pd.DataFrame({"w": ["\x01odd", *[f"https://site.example/{i % 400:04d}" for i in range(1200)], *["https://site.example/0007"] * 2000]})
    words["id"] = np.arange(len(words))
    df = spark.createDataFrame(words)
    assert O.sliced(df, ["w", "id"]).groupBy(O.SLICE).count().agg({"count": "max"}).first()[0] < len(words) / 3
    got = O.row_numbers(df, "w", "id").toPandas().sort_values("row_number")
    want = words.sort_values(["w", "id"])
    assert got["row_number"].tolist() == list(range(1, len(words) + 1)) and got["id"].tolist() == want["id"].tolist()


def test_previous_row_with_ties(spark, frame):
    got = O.previous_row(spark.createDataFrame(frame), "v", {"before": "id"}, ["key"], tie="id").toPandas()
    want = frame.sort_values(["v", "id"])
    want["want"] = want.groupby("key")["id"].shift(1)
    both = got.merge(want[["id", "want"]], on="id")
    assert np.allclose(both["before"].astype(float), both["want"].astype(float), equal_nan=True)
