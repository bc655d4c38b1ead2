"""Group statistics, profiles, correlations and histograms."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.operators.cleaning import unpivot_row
from lodestat.operators.ordered import ntile_from_rank, running_totals
from lodestat.operators.quantiles import attach, exact_quantiles, melt, quantile_values, value_ranks
from lodestat.session import checkpointed

SIMPLE = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "nunique": F.count_distinct,
    "count": F.count,
}


def group_stats(
    df: DataFrame, keys: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], order: Column
) -> DataFrame:
    """Per key: mean, std, min, max, last of numerics; count, last, distinct of categoricals."""
    made = []
    for c in numeric:
        made += [SIMPLE[f](c).alias(f"{c}_{f}") for f in ("mean", "std", "min", "max")]
        made.append(F.max_by(c, order).alias(f"{c}_last"))
    for c in categorical:
        made += [F.count(c).alias(f"{c}_count"), F.max_by(c, order).alias(f"{c}_last")]
    wide = df.groupBy(*keys).agg(*made)
    for c in categorical:
        # two-step distinct count: the (key, value) pairs are folded before the shuffle
        uniques = df.select(*keys, c).distinct().groupBy(*keys).agg(F.count(c).alias(f"{c}_nunique"))
        wide = attach(wide, uniques, keys)
    return wide


def group_transform(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], functions: Sequence[str], last_by: Column | None = None
) -> DataFrame:
    """Bind ``<column>_<function>_by_<group>`` to every row, one aggregate and one join per group.

    An aggregate folds a hot group before the shuffle; a window over the group would not.
    """
    out = df
    for g in groups:
        made = [SIMPLE[f](c).alias(f"{c}_{f}_by_{g}") for c, f in product(columns, functions) if f in SIMPLE]
        if "last" in functions:
            made += [F.max_by(c, last_by).alias(f"{c}_last_by_{g}") for c in columns]
        stats = df.groupBy(g).agg(*made) if made else df.select(g).distinct()
        if "median" in functions:
            medians = exact_quantiles(df, columns, {"median": 0.5}, [g])
            cells = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"{c}_median_by_{g}") for c in columns]
            stats = attach(stats, medians.groupBy(g).agg(*cells), [g])
        out = attach(out, stats, [g])
    return out


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of every value; the total is a scalar of the counted table."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def describe(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    moments = df.agg(
        *[F.count(c).alias(f"{c}__count") for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns],
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}__std") for c in columns],
        *[F.min(c).alias(f"{c}__min") for c in columns],
        *[F.max(c).alias(f"{c}__max") for c in columns],
    )
    table = unpivot_row(moments, columns, ["count", "nulls", "mean", "std", "min", "max"])
    quantiles = exact_quantiles(df, columns, probabilities).drop("size")
    return attach(table, quantiles, ["column"])


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the least value on ties."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    ).filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(best.alias("_b")).select("column", "_b.value", "_b.n")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, share, total/count, balanced weight, half weight."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).alias("w")).scalar()
    n = F.col("n")
    return counts.select(
        label,
        "n",
        (n / whole["total"]).alias("share"),
        (whole["total"] / n).alias("inverse"),
        (whole["total"] / (whole["classes"] * n)).alias("balanced"),
        (whole["total"] / (2 * n)).alias("half"),
    )


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair from one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}__r") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}__r`").alias("r")) for a, b in pairs]
    return row.select(F.inline(F.array(*cells)))


def with_midranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_rank``, the average rank of the value in the whole table."""
    out = df
    ranks = value_ranks(melt(df, columns), ["column"])
    for c in columns:
        one = ranks.filter(F.col("column") == c).select(
            F.col("value").alias("_v"), (F.col("upto") - (F.col("n") - 1) / 2).alias(f"{c}_rank")
        )
        out = attach(out.withColumn("_v", F.col(c).cast("double")), one, ["_v"]).drop("_v")
    return out


def spearman_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    ranked = with_midranks(df.select(*columns), columns)
    table = correlation_table(ranked, [f"{c}_rank" for c in columns])
    bare = lambda c: F.regexp_replace(c, "_rank$", "")
    return table.select(bare("a").alias("a"), bare("b").alias("b"), "r")


def kendall_tau_b(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b in n log n work.

    The y values are numbered in order. Two rows with different numbers first differ, read from
    the top, at exactly one binary digit; for each digit the rows that share the digits above it
    form a group, and a running count along x of the rows with digit 0 counts the concordant pairs
    of that group. No pair of rows is ever formed.
    """
    cells = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    cells = cells.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    ys = cells.select("y").distinct().withColumn("_one", F.lit(1))
    numbered = running_totals(ys, "y", ["_one"]).select("y", (F.col("cum__one") - 1).alias("code"))
    cells = attach(cells, numbered, ["y"])
    top = cells.agg(F.max("code")).first()[0] or 0
    digits = max(1, int(top).bit_length())
    levels = cells.select("x", "n", "code", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("level"))
    bit = F.expr("shiftright(code, level) & 1")
    group = F.expr("shiftright(code, level + 1)")
    folded = levels.groupBy("level", group.alias("prefix"), "x").agg(
        F.sum(F.when(bit == 0, F.col("n")).otherwise(0)).alias("zeros"),
        F.sum(F.when(bit == 1, F.col("n")).otherwise(0)).alias("ones"),
    )
    summed = running_totals(folded, "x", ["zeros"], ["level", "prefix"])
    agree = summed.agg(F.sum(F.col("ones").cast("double") * (F.col("cum_zeros") - F.col("zeros"))).alias("c"))

    def tied(*by: str) -> DataFrame:
        sizes = cells.groupBy(*by).agg(F.sum("n").alias("m"))
        return sizes.agg(F.sum(F.col("m").cast("double") * (F.col("m") - 1) / 2))

    total = cells.agg(F.sum("n").cast("double").alias("n"))
    row = agree.select(
        F.coalesce("c", F.lit(0.0)).alias("concordant"),
        (total.scalar() * (total.scalar() - 1) / 2).alias("pairs"),
        tied("x").scalar().alias("tie_x"),
        tied("y").scalar().alias("tie_y"),
        tied("x", "y").scalar().alias("tie_xy"),
    )
    discordant = F.col("pairs") - F.col("tie_x") - F.col("tie_y") + F.col("tie_xy") - F.col("concordant")
    return row.withColumn("discordant", discordant).select(
        "concordant",
        "discordant",
        (
            (F.col("concordant") - F.col("discordant"))
            / (F.sqrt(F.col("pairs") - F.col("tie_x")) * F.sqrt(F.col("pairs") - F.col("tie_y")))
        ).alias("tau_b"),
    )


def rows_per_chunk(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """Cut the sorted distinct keys in equal parts; keys and rows of each part."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_one", F.lit(1))
    total = per_key.agg(F.count(F.lit(1))).scalar()
    placed = running_totals(per_key, key, ["_one"])
    placed = placed.withColumn("chunk", ntile_from_rank(F.col("cum__one"), total, chunks))
    return placed.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")
    )


def poisson_one(uniform: Column) -> Column:
    """A Poisson(1) draw from a uniform number by its distribution function, as far as a double can tell it from one."""
    edges, mass, total = [], 0.36787944117144233, 0.0
    while total + mass > total:
        total += mass
        edges.append(total)
        mass /= len(edges)
    draw = F.lit(len(edges))
    for k in range(len(edges) - 1, -1, -1):
        draw = F.when(uniform < edges[k], k).otherwise(draw)
    return draw


def bootstrap_correlation(df: DataFrame, ids: str, x: str, y: str, replicates: int, level: float = 0.95, seed: int = 42) -> DataFrame:
    """Correlation with a bootstrap interval: every row gets a Poisson(1) weight per replicate.

    The weights come from a hash of (id, replicate, seed). Replicates are folded inside each task,
    so only one short row per task and replicate is exchanged.
    """
    rows = df.select(ids, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    copies = rows.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    uniform = (F.xxhash64(ids, "replicate", F.lit(seed)) / F.lit(2.0**64)) + 0.5
    copies = copies.withColumn("w", poisson_one(uniform).cast("double"))
    w, a, b = F.col("w"), F.col("x"), F.col("y")
    sums = copies.groupBy("replicate").agg(
        F.sum(w).alias("sw"), F.sum(w * a).alias("sx"), F.sum(w * b).alias("sy"),
        F.sum(w * a * a).alias("sxx"), F.sum(w * b * b).alias("syy"), F.sum(w * a * b).alias("sxy"),
    )
    cov = F.expr("sxy / sw - sx / sw * sy / sw")
    spread = F.expr("sqrt((sxx / sw - pow(sx / sw, 2)) * (syy / sw - pow(sy / sw, 2)))")
    tail = (1 - level) / 2
    # one row per replicate: the number of replicates is an argument, not a property of the data
    ends = sums.select((cov / spread).alias("r")).agg(
        F.percentile("r", F.lit(tail)).alias("low"), F.percentile("r", F.lit(1 - tail)).alias("high")
    )
    point = df.agg(F.corr(x, y)).scalar()
    return ends.select(point.alias("r"), "low", "high")


def stone_bins(df: DataFrame, column: str) -> int:
    """The number of equal-width bins with the least leave-one-out estimate of the squared error (ties: the fewest).

    All numbers up to max(100, root of n) are judged. Bins are [a, b), the last closed; the rows below an edge are a running count
    over distinct values and edges in one order, so the values are sorted once for all numbers together. Edges grow as the rows do.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    values = checkpointed(values)
    whole = values.agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n, lo, hi = whole["n"] or 0, whole["lo"], whole["hi"]
    if n < 2 or not lo < hi:
        return 1
    numbers = df.sparkSession.range(1, max(100, math.isqrt(n)) + 1).select(F.col("id").alias("k"))
    places = numbers.where("k > 1").select("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k") - 1)).alias("i"))
    # an edge comes before the values equal to it, which belong to the bin above
    edges = places.select(F.struct((F.col("i") * (F.lit(hi - lo) / F.col("k")) + lo).alias("v"), F.lit(0).alias("kind")).alias("at"), F.lit(0).cast("long").alias("n"), "k", "i")
    held = values.select(F.struct("v", F.lit(1).alias("kind")).alias("at"), "n", F.lit(None).cast("long").alias("k"), F.lit(None).cast("long").alias("i"))
    below = running_totals(edges.unionByName(held), "at", ["n"]).where("k IS NOT NULL").select("k", "i", F.col("cum_n").alias("below"))
    ends = numbers.select("k", F.col("k").alias("i"), F.lit(n).alias("below"))
    before = F.lag("below", 1, 0).over(Window.partitionBy("k").orderBy("i"))
    shares = below.unionByName(ends).select("k", ((F.col("below") - before) / F.lit(float(n))).alias("p"))
    risk = (2 - (n + 1) * F.sum(F.col("p") * F.col("p"))) * F.col("k")
    return shares.groupBy("k").agg(risk.alias("risk")).orderBy("risk", "k").first()["k"]


RULES = ("sqrt", "sturges", "rice", "scott", "doane", "fd", "auto", "stone")


def histogram_rules(df: DataFrame, column: str, rules: Sequence[str] = RULES) -> DataFrame:
    """Number of equal-width bins a numeric column gets under the usual rules, one row per rule.

    One bin for a constant column and for rules that are undefined on so few rows; no row for an empty column.
    """
    if df.filter(F.col(column).isNotNull()).isEmpty():
        return df.sparkSession.createDataFrame([], "rule string, width double, bins long, lo double, hi double")
    q = quantile_values(df, [column], {"q1": 0.25, "q3": 0.75})
    c = F.col(column).cast("double")
    row = df.agg(
        F.count(c).cast("double").alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
        F.stddev_pop(c).alias("sd"), F.skewness(c).alias("g1"),
    ).withColumn("iqr", F.lit(q[f"{column}_q3"] - q[f"{column}_q1"]))
    span = F.col("hi") - F.col("lo")
    n = F.col("n")
    widths = {
        "sqrt": span / F.sqrt(n),
        "sturges": span / (F.log2(n) + 1),
        "rice": span / (2 * F.pow(n, F.lit(1 / 3))),
        "scott": F.pow(24 * F.sqrt(F.lit(3.141592653589793)) / n, F.lit(1 / 3)) * F.col("sd"),
        "doane": span
        / (1 + F.log2(n) + F.log2(1 + F.coalesce(F.try_divide(F.abs("g1"), F.sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))), F.lit(0.0)))),
        "fd": 2 * F.col("iqr") / F.pow(n, F.lit(1 / 3)),
    }
    if "stone" in rules:
        widths["stone"] = span / stone_bins(df, column)
    widths["auto"] = F.when(widths["fd"] > 0, F.least(widths["fd"], widths["sturges"])).otherwise(widths["sturges"])
    bins = lambda w: F.when((w > 0) & (span > 0), F.ceil(span / w)).otherwise(1).cast("long")
    cells = [
        F.struct(F.lit(name).alias("rule"), w.alias("width"), bins(w).alias("bins"), F.col("lo"), F.col("hi"))
        for name, w in widths.items()
        if name in rules
    ]
    return row.select(F.inline(F.array(*cells)))
