"""Graphs, neighbours, clusters, splits and trees against brute force on small tables."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestat.operators import clustering as C, graph as G, neighbours as N, splits as Sp, trees as T
from lodestat.operators.density import dbscan

EDGES = [(0, 1), (0, 2), (1, 2), (2, 3), (3, 4), (4, 5), (3, 5), (5, 6), (6, 7), (0, 7)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src long, dst long")


def _all_shortest_paths(n, edges):
    links = {i: set() for i in range(n)}
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    out = {}
    for s in range(n):
        level, found = {s: [[s]]}, {s: [[s]]}
        while level:
            fresh = {}
            for v, paths in level.items():
                for w in links[v]:
                    if w not in found:
                        fresh.setdefault(w, []).extend(p + [w] for p in paths)
            found.update(fresh)
            level = fresh
        out[s] = found
    return out


def test_hops_closeness_betweenness(spark, edges):
    paths = _all_shortest_paths(8, EDGES)
    d = G.hop_distances(edges, spark.range(8).withColumnRenamed("id", "source"))
    got = {(r["source"], r["node"]): (r["hops"], r["paths"]) for r in d.collect()}
    assert got == {(s, v): (len(p[0]) - 1, len(p)) for s, f in paths.items() for v, p in f.items()}
    want = dict.fromkeys(range(8), 0.0)
    for s, t in itertools.combinations(range(8), 2):
        for p in paths[s][t]:
            for v in p[1:-1]:
                want[v] += 1 / len(paths[s][t])
    scale = 7 * 6 / 2
    found = {r["node"]: r["betweenness"] for r in G.betweenness(edges, d, 8, 8).collect()}
    for v in want:
        assert found[v] == pytest.approx(want[v] / scale)


def test_triangles(edges):
    assert {(r["a"], r["b"], r["c"]) for r in G.triangles(edges).collect()} == {(0, 1, 2), (3, 4, 5)}


def test_link_candidates_with_narrow_start(spark, edges):
    scores = spark.createDataFrame([(i, float(i % 5)) for i in range(8)], "node long, score double")
    got = {(r["a"], r["b"]): r["combined"] for r in G.link_candidates(edges, scores, top=2, start=1).collect()}
    links = {frozenset(e) for e in EDGES}
    near = {v: {w for e in links if v in e for w in e if w != v} for v in range(8)}
    all_pairs = {
        (a, b): float(a % 5 + b % 5)
        for a, b in itertools.combinations(range(8), 2)
        if frozenset((a, b)) not in links and near[a] & near[b]
    }
    best = sorted(set(all_pairs.values()))[-2:]
    assert got == {p: s for p, s in all_pairs.items() if s in best}


def test_cheapest_path(spark):
    e = spark.createDataFrame([(0, 1, 4.0), (0, 2, 1.0), (1, 2, 2.0), (1, 3, 5.0)], "src long, dst long, w double")
    got = {r["node"]: (r["cost"], r["path"]) for r in G.cheapest_paths(e, 0, "w").collect()}
    assert got == {0: (0.0, [0]), 2: (1.0, [0, 2]), 1: (3.0, [0, 2, 1]), 3: (8.0, [0, 2, 1, 3])}


def test_knn_with_copies(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(150, 4)), np.repeat(rng.normal(size=(1, 4)), 80, axis=0)])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    got = N.knn_join(df, df, "id", "v", 3, pivots=7).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for q, part in got.groupby("query"):
        want = np.lexsort((np.arange(len(x)), d[q]))[:3]
        assert part.sort_values("rank")["neighbour"].tolist() == want.tolist()


def test_dbscan_with_a_crowded_spot(spark):
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.normal(0, 0.6, (80, 2)), rng.normal(4, 0.6, (80, 2)), rng.uniform(-3, 7, (40, 2)), np.repeat([[0.1, 0.1]], 60, 0)])
    eps, least = 0.5, 6
    got = dbscan(spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], "i long, x double, y double"), "i", "x", "y", eps, least)
    got = got.toPandas().sort_values("i")
    near = ((p[:, None] - p[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    assert (got["core"].to_numpy() == core).all()
    assert (got["cluster"].isna().to_numpy() == (~core & ~(near & core[None]).any(1))).all()
    label, fresh = -np.ones(len(p), int), 0
    for i in np.flatnonzero(core):
        if label[i] < 0:
            stack = [i]
            label[i] = fresh
            while stack:
                for q in np.flatnonzero(near[stack.pop()] & core & (label < 0)):
                    label[q] = fresh
                    stack.append(q)
            fresh += 1
    pairs = set(zip(label[core], got["cluster"].to_numpy()[core]))
    assert len(pairs) == fresh == len({c for _, c in pairs})


def test_kmeans_assignment_example(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)], "x double, y double")
    rows, _ = C.lloyd(df, ["x", "y"], [(0.0, 0.0), (1.0, 1.0)], 0)
    assert [r["cluster"] for r in rows.orderBy("x").collect()] == [1, 1, 1]


def test_medoids_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(120), "g": rng.integers(0, 3, 120), "a": rng.integers(0, 20, 120).astype(float), "c": rng.choice(list("xyz"), 120)})
    got = C.gower_medoids(spark.createDataFrame(pdf), "id", "g", ["a"], ["c"], {"a": 19.0}).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        a, c = part["a"].to_numpy(), part["c"].to_numpy()
        total = ((np.abs(a[:, None] - a[None]) / 19 + (c[:, None] != c[None])) / 2).sum(1).round(6)
        assert got.loc[g, "total"] == pytest.approx(total.min())
        assert got.loc[g, "medoid"] == part["id"].to_numpy()[total.argmin()]


def test_tree_finds_the_rule(spark):
    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({"a": rng.integers(0, 20, 800).astype(float), "b": rng.integers(0, 20, 800).astype(float)})
    pdf["y"] = np.where(pdf["a"] <= 7, "p", np.where(pdf["b"] <= 12, "q", "r"))
    df = spark.createDataFrame(pdf)
    rules = T.grow(df, ["a", "b"], "y", depth=2)
    assert df.filter(rules.predict() != F.col("y")).count() == 0
    assert {v for _, v in rules.splits.values()} == {7.5, 12.5}


def test_splits_are_disjoint_and_complete(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 91).withColumn("y", F.col("id") % 3 == 0)
    split = Sp.split_by_bucket(df, ["id"], {"a": 0.6, "b": 0.3, "c": 0.1})
    shares = {r["split"]: r["count"] / 5000 for r in split.groupBy("split").count().collect()}
    assert shares["a"] == pytest.approx(0.6, abs=0.05)
    groups = Sp.split_groups(df, "g", F.col("y"), {"train": 6, "test": 4})
    assert groups.count() == groups.select("g").distinct().count() == 91
    parts = [split.filter(F.col("split") == s) for s in "abc"]
    assert Sp.check_cover(df, parts, "id").first().asDict() == {"keys": 5000, "disjoint": True, "complete": True}


def test_sliding_windows_are_all_complete_splits(spark):
    days = spark.range(40).withColumnRenamed("id", "day")
    got = {}
    for r in Sp.sliding_windows(days, "day", window=14, horizon=3, step=3).collect():
        got.setdefault((r["split"], r["part"]), []).append(r["day"])
    splits = range(0, (40 - 17) // 3 + 1)
    assert {s for s, _ in got} == set(splits)
    for s in splits:
        assert sorted(got[s, "train"]) == list(range(3 * s, 3 * s + 14)) and sorted(got[s, "test"]) == list(range(3 * s + 14, 3 * s + 17))


def test_tree_counts_every_class(spark):
    from lodestat.operators import trees as Tr

    rows = spark.range(3600).selectExpr("CAST(id % 1200 AS DOUBLE) AS x", "CAST(id % 1200 AS INT) AS y")
    best = Tr.best_splits(rows.withColumn("node", F.lit(0)), ["x"], "y", "entropy").first()
    assert best["threshold"] == 599.5 and best["gain"] == pytest.approx(1.0)
    gini = Tr.best_splits(rows.withColumn("node", F.lit(0)), ["x"], "y").first()
    assert gini["gain"] == pytest.approx(1 / 1200)


def test_knn_meets_a_vector_once_a_group(spark):
    """1 500 vectors in dozens of cells, far from the origin, with copies: exact, and no join of exploded blocks is left to a broadcast of them."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(1400, 6)) + 1e6, np.repeat(rng.normal(size=(1, 6)), 100, axis=0)])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    found = N.knn_join(df.where("id % 3 = 0"), df, "id", "v", 4)
    got = {q: p.sort_values("rank") for q, p in found.toPandas().groupby("query")}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert sorted(got) == list(range(0, 1500, 3))
    for q, part in got.items():
        assert part["neighbour"].tolist() == np.lexsort((np.arange(len(x)), d[q]))[:4].tolist()
        assert np.allclose(part["distance"], np.sort(d[q])[:4], rtol=1e-12)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and plan.count("Join") == 1 and "rightHint=(strategy=broadcast)" in plan


def test_nearest_rows_measures_few_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    x, asked, measure = rng.normal(size=(4000, 16)), [], N._distances
    monkeypatch.setattr(N, "_distances", lambda a, i, b, j: asked.append(len(i)) or measure(a, i, b, j))
    blocks = [(np.arange(i, i + 500), np.arange(i, i + 500), x[i : i + 500]) for i in range(0, 4000, 500)]
    row, found, far = N.nearest_rows(x[:200], np.arange(200), np.full(200, np.inf), blocks, 3)
    d = N.pair_distances(x[:200], x)
    d[np.arange(200), np.arange(200)] = np.inf
    assert found.reshape(200, 3).tolist() == np.argsort(d, axis=1, kind="stable")[:, :3].tolist()
    assert (far == np.take_along_axis(d, found.reshape(200, 3), 1).ravel()).all() and sum(asked) < d.size / 50
