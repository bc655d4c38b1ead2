import warnings
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import drift
from lodestat.operators.aggregates import histogram_rules, stone_bins
from lodestat.operators.resampling import border_classes, borderline_smote


def plain_stone(x):
    """Every number of bins by its own histogram."""
    span, n = np.ptp(x), len(x)

    def risk(k):
        p = np.histogram(x, bins=k)[0] / n
        return (2 - (n + 1) * p.dot(p)) * k / span

    return min(range(1, max(100, int(np.sqrt(n))) + 1), key=risk)


SAMPLES = {
    "normal": np.random.default_rng(1).standard_normal(500),
    "two heaps": np.r_[np.random.default_rng(2).normal(0, 1, 300), np.random.default_rng(3).normal(30, 0.5, 900)],
    "ties on edges": np.random.default_rng(4).integers(0, 11, 400).astype(float),
    "more than a hundred": np.random.default_rng(5).exponential(1, 12_000),
    "two values": np.array([1.0, 2.0]),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_stone_against_brute_force(spark, name):
    x = SAMPLES[name]
    table = spark.createDataFrame([(float(v),) for v in x], "x double").unionByName(spark.createDataFrame([(None,)], "x double"))
    want = plain_stone(x)
    assert stone_bins(table, "x") == want
    row = histogram_rules(table, "x", ["stone"]).first()
    assert abs(row["width"] - np.ptp(x) / want) < 1e-12
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert row["bins"] == len(np.histogram_bin_edges(x, "stone")) - 1


@pytest.mark.parametrize("values", [[3.0], [4.0, 4.0, 4.0]])
def test_no_spread_is_one_bin(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x double")
    assert stone_bins(table, "x") == 1 and {r["bins"] for r in histogram_rules(table, "x").collect()} == {1}


def test_empty_column_and_drift(spark):
    assert histogram_rules(spark.createDataFrame([(None,)], "x double"), "x").collect() == []
    a, b = SAMPLES["normal"], SAMPLES["normal"] * 1.5 + 0.3
    sides = [spark.createDataFrame([(float(v),) for v in x], "x double") for x in (a, b)]
    row = drift.psi(*sides, "x", "stone").first()
    edges = np.histogram_bin_edges(a, plain_stone(a))
    edges[0], edges[-1] = -np.inf, np.inf
    q, p = (np.where(h == 0, 1e-6, h / h.sum()) for h in (np.histogram(x, edges)[0] for x in (a, b)))
    q, p = q / q.sum(), p / p.sum()
    assert abs(row["psi"] - ((p - q) * np.log(p / q)).sum()) < 1e-9
    with pytest.raises(ValueError, match="unknown rule"):
        drift.psi(*sides, "x", "square")


def points(seed=6, n=240):
    """A rare label inside, at the border of and far from the others."""
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, 2))
    rare = (np.hypot(*(x - 1.2).T) < 0.6) | (draw.random(n) < 0.04)
    x[0], rare[0] = (9.0, 9.0), True
    return x, np.where(rare, "rare", "often")


def plain_borders(x, labels, m):
    out = {}
    for i in np.flatnonzero(labels == "rare"):
        d = np.hypot(*(x - x[i]).T)
        near = sorted((d[j], j) for j in range(len(x)) if j != i)[:m]
        others = sum(labels[j] != "rare" for _, j in near)
        out[int(i)] = (others, "noise" if others == m else "danger" if 2 * others >= m else "safe")
    return out


def table_of(spark, x, labels):
    return spark.createDataFrame([(i, [float(c) for c in v], str(k)) for i, (v, k) in enumerate(zip(x, labels))], "id long, v array<double>, label string")


def test_border_classes_against_brute_force(spark):
    x, labels = points()
    found = {r["query"]: (r["others"], r["border"]) for r in border_classes(table_of(spark, x, labels), "id", "v", "label", "rare", 5).collect()}
    assert found == plain_borders(x, labels, 5)
    assert set(Counter(b for _, b in found.values())) == {"noise", "danger", "safe"}


@pytest.mark.parametrize("kind", [1, 2])
def test_only_rows_in_danger_are_multiplied(spark, kind):
    x, labels = points()
    danger = {i for i, (_, b) in plain_borders(x, labels, 5).items() if b == "danger"}
    made = borderline_smote(table_of(spark, x, labels), "id", "v", "label", "rare", 3, k=4, neighbours=5, kind=kind).collect()
    assert Counter(r["origin"] for r in made) == {i: 3 * kind for i in danger}
    assert len({r["row"] for r in made}) == len(made) and {r["label"] for r in made} == {"rare"}
    for r in made:
        over = r["row"].endswith("-o")
        own = [j for j in range(len(x)) if (labels[j] == "rare") != over and j != r["origin"]]
        near = sorted(own, key=lambda j: (np.hypot(*(x[j] - x[r["origin"]])), j))[:4]
        a, p = x[r["origin"]], np.array(r["v"])
        shares = [(p - a) @ (x[j] - a) / ((x[j] - a) @ (x[j] - a)) for j in near]
        assert any(np.allclose(p, a + u * (x[j] - a), atol=1e-9) and -1e-9 <= u <= (0.5 if over else 1) + 1e-9 for u, j in zip(shares, near))


def test_no_row_in_danger(spark):
    x, labels = points()
    table = table_of(spark, x, labels)
    assert borderline_smote(table.where(F.col("label") == "rare"), "id", "v", "label", "rare", 3).collect() == []
    alone = table.where("id = 0")
    assert [tuple(r) for r in border_classes(alone, "id", "v", "label", "rare").collect()] == [(0, 0, "safe")]
    with pytest.raises(ValueError, match="kind"):
        borderline_smote(table, "id", "v", "label", "rare", 3, kind=3)
