"""A classification tree grown by grouped counts: one pass per level for all nodes and features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import previous_row, running_totals
from lodestat.session import checkpointed


def best_splits(
    df: DataFrame, features: Sequence[str], label: str, criterion: str = "gini", min_decrease: float = 0.0, node: str = "node"
) -> DataFrame:
    """Per node the split (feature, threshold, gain) with the least weighted impurity.

    Thresholds are midpoints of neighbouring distinct values; ties go to the first feature, then
    the least threshold. Rows fold to counts per (node, feature, class, value) before any exchange, and classes stay
    rows, however many there are. Gini and entropy are sums over classes of g(count), so each class adds the change of
    g at its own values, and running totals of these changes give both sides at every threshold.
    """
    g = (lambda c: c * c) if criterion == "gini" else (lambda c: F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("value")) for i, c in enumerate(features)])
    long = df.select(node, F.col(label).alias("_y"), F.inline(cells))
    counts = long.groupBy(node, "f", "_y", "value").agg(F.count(F.lit(1)).cast("double").alias("c"))
    whole = df.groupBy(node, F.col(label).alias("_y")).agg(F.count(F.lit(1)).cast("double").alias("t"))
    each = running_totals(counts, "value", ["c"], [node, "f", "_y"]).join(whole, [node, "_y"])
    before, after, t = F.col("cum_c") - F.col("c"), F.col("cum_c"), F.col("t")
    changes = each.groupBy(node, "f", "value").agg(
        F.sum("c").alias("n"), F.sum(g(after) - g(before)).alias("left"), F.sum(g(t - after) - g(t - before)).alias("right")
    )
    summed = running_totals(changes, "value", ["n", "left", "right"], [node, "f"])
    kept = {"before": "value", "nl": "cum_n", "gl": "cum_left", "gr": "cum_right"}
    rows = previous_row(summed, "value", kept, [node, "f"]).filter(F.col("before").isNotNull())
    per = whole.groupBy(node).agg(F.sum("t").alias("n_all"), F.sum(g(F.col("t"))).alias("g_all"))
    rows = rows.join(per, node).withColumn("nr", F.col("n_all") - F.col("nl"))

    def spread(n: Column, total: Column) -> Column:
        """n times the impurity of n rows whose classes have this sum of g."""
        return n - F.try_divide(total, n) if criterion == "gini" else g(n) - total

    left_spread, right_spread = spread(F.col("nl"), F.col("gl")), spread(F.col("nr"), F.col("g_all") + F.col("gr"))
    rows = rows.withColumn("after", (left_spread + right_spread) / F.col("n_all"))
    rows = rows.withColumn("gain", spread(F.col("n_all"), F.col("g_all")) / F.col("n_all") - F.col("after")).filter(F.col("gain") > min_decrease)
    threshold = (F.col("before") + F.col("value")) / 2
    best = rows.groupBy(node).agg(
        F.min(F.struct(F.round("after", 12).alias("after"), F.col("f"), threshold.alias("threshold"), F.col("gain"))).alias("b")
    )
    table = F.array(*[F.lit(f) for f in features])
    return best.select(node, F.get(table, F.col("b.f")).alias("feature"), "b.threshold", "b.gain")


@dataclass
class Rules:
    """A fitted tree: splits by node number (children 2n + 1 and 2n + 2) and the class of every leaf."""

    splits: dict[int, tuple[str, float]] = field(default_factory=dict)
    leaves: dict[int, object] = field(default_factory=dict)

    def node(self, at: int = 0) -> Column:
        if at not in self.splits:
            return F.lit(at)
        feature, threshold = self.splits[at]
        return F.when(F.col(feature) <= threshold, self.node(2 * at + 1)).otherwise(self.node(2 * at + 2))

    def predict(self, at: int = 0) -> Column:
        if at not in self.splits:
            return F.lit(self.leaves[at])
        feature, threshold = self.splits[at]
        return F.when(F.col(feature) <= threshold, self.predict(2 * at + 1)).otherwise(self.predict(2 * at + 2))


def grow(
    df: DataFrame, features: Sequence[str], label: str, depth: int, criterion: str = "gini", min_rows: int = 2, min_decrease: float = 0.0
) -> Rules:
    """Grow to a depth; a row per node, 2^(depth + 1) at most, reaches the driver. Ties of classes go to the least."""
    kept = checkpointed(df.select(*dict.fromkeys([*features, label])))
    rules, open_nodes = Rules(), {0}
    for level in range(depth + 1):
        placed = kept.withColumn("node", rules.node())
        by_class = placed.groupBy("node", label).agg(F.count(F.lit(1)).alias("c"))
        top = F.min(F.struct((-F.col("c")).alias("c"), F.col(label).alias("y"))).alias("top")
        ready = set()
        for r in by_class.groupBy("node").agg(top, F.sum("c").alias("n"), F.count(F.lit(1)).alias("classes")).collect():
            rules.leaves[r["node"]] = r["top"]["y"]
            if r["node"] in open_nodes and r["classes"] > 1 and r["n"] >= min_rows:
                ready.add(r["node"])
        if level == depth or not ready:
            break
        found = best_splits(placed.filter(F.col("node").isin(*ready)), features, label, criterion, min_decrease).collect()
        open_nodes = set()
        for r in found:
            rules.splits[r["node"]] = (r["feature"], r["threshold"])
            open_nodes |= {2 * r["node"] + 1, 2 * r["node"] + 2}
        if not found:
            break
    return rules
