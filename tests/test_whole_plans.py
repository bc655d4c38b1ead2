"""Plans take the whole of what their operators offer."""

import pytest
from pyspark.sql import functions as F

from lodestat.operators import graph as G
from lodestat.operators import learners as L
from lodestat.plans import load
from lodestat.plans.registry import PLANS, Tables

load()

FOLDER = "/root/testdata/sf0.001"


def test_ensembles_keep_the_operators_sizes(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(L, "tree_learner", lambda kind, seed=42, **size: asked.append((kind, size)) or 1 / 0)
    for key in ("forest_and_boosting", "score_batches"):
        try:
            PLANS[key](Tables(spark, FOLDER))
        except ZeroDivisionError:
            pass
    assert asked == [("tree", {}), ("forest", {})]


@pytest.mark.parametrize(
    "key, columns",
    [
        ("graph_betweenness", ["node", "betweenness_from_sources"]),
        ("graph_closeness", ["node", "closeness"]),
    ],
)
def test_paths_start_from_all_keys_divisible_by_50(spark, monkeypatch, key, columns):
    name = "hop_distances" if key == "graph_betweenness" else "hops_from"
    asked, search = [], getattr(G, name)
    monkeypatch.setattr(G, name, lambda e, start: asked.append((e, start)) or search(e, start))
    got = PLANS[key](Tables(spark, FOLDER))
    edges, start = asked[0]
    nodes = {r.node for r in G.degrees(edges).collect()}
    assert sorted(r.source for r in start.collect()) == sorted(n for n in nodes if n % 50 == 0) and got.columns == columns


@pytest.mark.parametrize(
    "key, columns",
    [
        ("graph_shortest_paths", ["source", "node", "hops"]),
        ("graph_mean_path_length", ["mean_hops_from_sources", "farthest_from_sources"]),
    ],
)
def test_paths_and_their_mean_start_from_every_node(spark, monkeypatch, key, columns):
    asked, search = [], G.hops_from
    monkeypatch.setattr(G, "hops_from", lambda e, start: asked.append((e, start)) or search(e, start))
    got = PLANS[key](Tables(spark, FOLDER))
    edges, start = asked[0]
    assert sorted(r.source for r in start.collect()) == sorted(r.node for r in G.degrees(edges).collect()) and got.columns == columns


@pytest.mark.parametrize("search", [G.hop_distances, G.hops_from])
def test_hops_have_no_limit(spark, search):
    """A path of 40 nodes is walked to its end."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(39)], "src long, dst long")
    reached = search(edges, spark.createDataFrame([(0,)], "source long")).collect()
    assert sorted((r.node, r.hops) for r in reached) == [(i, i) for i in range(40)]


def test_packed_sources_give_the_same_hops(spark):
    """150 sources, so three longs, one of them outside the graph; several components."""
    edges = G.simple_edges(spark.range(400).selectExpr("id % 200 AS a", "pmod(xxhash64(id), 230) AS b", "1 AS c").where("a <> b"), "a", "b", ["c"], F.struct("c"))
    start = spark.range(150).select((F.col("id") * 2).alias("source"))
    key = lambda df: sorted((r.source, r.node, r.hops) for r in df.collect())
    assert key(G.hops_from(edges, start)) == key(G.hop_distances(edges, start))
    assert G.hops_from(edges, start.limit(0)).collect() == []
