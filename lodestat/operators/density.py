"""DBSCAN in the plane on grid cells, exact, without pairing the points of a crowded cell.

Cells have diagonal eps, so points of one cell are all neighbours. A cell with at least ``min_points``
points is made of core points; only points of thinner cells need neighbour counts, and a thin cell
has fewer than ``min_points`` points. Whether two crowded cells touch is settled by splitting their
bounding boxes, not by comparing their points.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import checkpointed

REACH = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]


def _around(df: DataFrame) -> DataFrame:
    steps = F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in REACH])
    return df.select("*", F.inline(steps)).withColumns({"ni": F.col("ci") + F.col("di"), "nj": F.col("cj") + F.col("dj")}).drop("di", "dj")


def _touching(boxes: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """Split box pairs in surely linked cells and undecided pairs; the rest is too far."""
    lo = lambda a, b, x, y: F.greatest(F.lit(0.0), F.col(f"{a}_lo{x}") - F.col(f"{b}_hi{x}"), F.col(f"{b}_lo{x}") - F.col(f"{a}_hi{x}"))
    hi = lambda a, b, x: F.greatest(F.col(f"{a}_hi{x}") - F.col(f"{b}_lo{x}"), F.col(f"{b}_hi{x}") - F.col(f"{a}_lo{x}"))
    near = F.pow(lo("a", "b", "x", ""), F.lit(2)) + F.pow(lo("a", "b", "y", ""), F.lit(2))
    far = F.pow(hi("a", "b", "x"), F.lit(2)) + F.pow(hi("a", "b", "y"), F.lit(2))
    alive = boxes.withColumns({"near": near, "far": far}).filter(F.col("near") <= eps * eps)
    linked = alive.filter(F.col("far") <= eps * eps).select("a", "b").distinct()
    return linked, alive.filter(F.col("far") > eps * eps).drop("near", "far")


FEW = 32


def cell_links(core: DataFrame, eps: float, side: float) -> DataFrame:
    """(a, b) of neighbouring core cells that hold two core points within eps.

    Box pairs are settled by their nearest and farthest corners, by their points when both boxes
    have at most FEW of them, and else by quartering both boxes.
    """
    base = core.select("cell", "ci", "cj", "x", "y")
    edges = ("lox", "hix", "loy", "hiy")

    def cut(n: int) -> DataFrame:
        part = lambda v, c: F.floor((F.col(v) - F.col(c) * F.lit(side)) / F.lit(side) * 2**n)
        return base.withColumns({"px": part("x", "ci"), "py": part("y", "cj")})

    def level(n: int) -> DataFrame:
        return cut(n).groupBy("cell", "ci", "cj", "px", "py").agg(
            F.min("x").alias("lox"), F.max("x").alias("hix"), F.min("y").alias("loy"), F.max("y").alias("hiy"),
            F.count(F.lit(1)).alias("m"),
        )

    def named(df: DataFrame, s: str, *keep: str) -> DataFrame:
        return df.select(F.col("cell").alias(s), *keep, *[F.col(c).alias(f"{s}_{c}") for c in ("px", "py", "m", *edges)])

    def by_points(pairs: DataFrame, n: int) -> DataFrame:
        points = cut(n)
        side_of = lambda s: points.select(
            F.col("cell").alias(s), F.col("px").alias(f"{s}_px"), F.col("py").alias(f"{s}_py"), F.col("x").alias(f"{s}_x"), F.col("y").alias(f"{s}_y")
        )
        gap = F.pow(F.col("a_x") - F.col("b_x"), F.lit(2)) + F.pow(F.col("a_y") - F.col("b_y"), F.lit(2))
        joined = pairs.select("a", "a_px", "a_py", "b", "b_px", "b_py").join(side_of("a"), ["a", "a_px", "a_py"])
        return joined.join(side_of("b"), ["b", "b_px", "b_py"]).filter(gap <= eps * eps).select("a", "b").distinct()

    top = checkpointed(level(0))
    right = named(top.withColumns({"ni": F.col("ci"), "nj": F.col("cj")}), "b", "ni", "nj")
    left = named(_around(top), "a", "ni", "nj")
    pairs = left.join(right, ["ni", "nj"]).filter("a < b").drop("ni", "nj")
    linked = None
    for n in count():
        fresh, still = _touching(pairs, eps)
        still = checkpointed(still)
        few = (F.col("a_m") <= FEW) & (F.col("b_m") <= FEW)
        fresh = fresh.union(by_points(still.filter(few), n))
        linked = checkpointed((fresh if linked is None else fresh.union(linked)).distinct())
        many = checkpointed(still.filter(~few).join(linked, ["a", "b"], "left_anti"))
        if many.isEmpty():
            return linked
        boxes = level(n + 1)
        half = lambda v: F.floor(F.col(v) / 2).alias(v)
        keys = many.select("a", F.col("a_px").alias("pa"), F.col("a_py").alias("qa"), "b", F.col("b_px").alias("pb"), F.col("b_py").alias("qb"))
        child_a = named(boxes, "a").select("*", half("a_px").alias("pa"), half("a_py").alias("qa"))
        child_b = named(boxes, "b").select("*", half("b_px").alias("pb"), half("b_py").alias("qb"))
        pairs = keys.join(child_a, ["a", "pa", "qa"]).join(child_b, ["b", "pb", "qb"]).drop("pa", "qa", "pb", "qb")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the least node of each connected part, by least labels and label jumping."""
    both = checkpointed(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))))
    labels = checkpointed(nodes.select("node", F.col("node").alias("component")))
    while True:
        offered = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        fresh = labels.join(offered, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        jump = fresh.select(F.col("node").alias("component"), F.col("component").alias("up"))
        fresh = checkpointed(fresh.join(jump, "component", "left").select("node", "old", F.least("component", "up").alias("component")))
        labels = fresh.select("node", "component")
        if fresh.filter("component <> old").isEmpty():
            return labels


def dbscan(df: DataFrame, id_: str, x: str, y: str, eps: float, min_points: int) -> DataFrame:
    """(id, cluster, core): cluster null for noise; a border point joins its least neighbouring cluster.

    Equal points are folded first and carry their number.
    """
    side = eps / 2**0.5 * (1 - 1e-12)
    spots = df.groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count(F.lit(1)).alias("m"))
    spots = spots.withColumns({"ci": F.floor(F.col("x") / side), "cj": F.floor(F.col("y") / side)}).withColumn("cell", F.concat_ws("|", "ci", "cj"))
    crowd = spots.groupBy("cell").agg(F.sum("m").alias("in_cell"))
    spots = checkpointed(spots.join(crowd, "cell"))
    thin = spots.filter(F.col("in_cell") < min_points)
    gap = F.pow(F.col("x") - F.col("ox"), F.lit(2)) + F.pow(F.col("y") - F.col("oy"), F.lit(2))
    others = spots.select(F.col("ci").alias("ni"), F.col("cj").alias("nj"), F.col("x").alias("ox"), F.col("y").alias("oy"), "m", F.col("cell").alias("other"))
    seen = _around(thin.drop("m")).join(others, ["ni", "nj"]).filter(gap <= eps * eps)
    counts = seen.groupBy("x", "y").agg(F.sum("m").alias("around"))
    marked = spots.join(counts, ["x", "y"], "left")
    marked = checkpointed(marked.withColumn("core", (F.col("in_cell") >= min_points) | (F.coalesce("around", F.lit(0)) >= min_points)))
    core = marked.filter("core")
    parts = components(core.select(F.col("cell").alias("node")).distinct(), cell_links(core, eps, side))
    named = core.join(parts.withColumnRenamed("node", "cell"), "cell").select("x", "y", F.col("component").alias("cluster"))
    # border points lie in thin cells; the rest of a cell with a core point is within eps of it
    targets = core.select(F.col("ci").alias("ni"), F.col("cj").alias("nj"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("cell").alias("other"))
    edge = _around(marked.filter(~F.col("core"))).join(targets, ["ni", "nj"]).filter(gap <= eps * eps)
    edge = edge.join(parts.select(F.col("node").alias("other"), "component"), "other").groupBy("x", "y").agg(F.min("component").alias("cluster"))
    clusters = named.withColumn("core", F.lit(True)).union(edge.select("x", "y", "cluster").withColumn("core", F.lit(False)))
    rows = df.select(id_, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return rows.join(clusters, ["x", "y"], "left").select(id_, "cluster", F.coalesce("core", F.lit(False)).alias("core"))
