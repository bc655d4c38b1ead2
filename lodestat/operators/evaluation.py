"""Model-evaluation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.operators import ranking as R
from lodestat.operators.quantiles import attach, value_ranks


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts per (truth, predicted) and their share of the true class."""
    cells = df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(truth).agg(F.sum("n").alias("_row"))
    return attach(cells, rows, [truth]).withColumn("share", F.col("n") / F.col("_row")).drop("_row")


def _guarded(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def binary_metrics(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    row = df.agg(
        F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"),
        F.count_if(truth & ~predicted).alias("fn"), F.count_if(~truth & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return row.select(
        "tp", "fp", "fn", "tn", _guarded(tp, tp + fp).alias("precision"), _guarded(tp, tp + fn).alias("recall"),
        _guarded(2 * tp, 2 * tp + fp + fn).alias("f1"), _guarded(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def balanced_accuracy(df: DataFrame, truth: str, predicted: str, fold: str) -> DataFrame:
    """Mean recall over classes per fold, and adjusted so that chance is 0."""
    recalls = df.groupBy(fold, truth).agg(F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("_r"))
    row = recalls.groupBy(fold).agg(F.avg("_r").alias("balanced"), F.count(F.lit(1)).alias("_k"))
    chance = 1 / F.col("_k")
    return row.select(fold, "balanced", ((F.col("balanced") - chance) / (1 - chance)).alias("adjusted"))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted rows.

    Each row is seen as a true class and as a predicted class, so one grouped count gives all.
    """
    seen = df.select(
        F.inline(
            F.array(
                F.struct(F.col(truth).cast("string").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("h")),
                F.struct(
                    F.col(predicted).cast("string").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                    (F.col(truth) == F.col(predicted)).cast("int").alias("h"),
                ),
            )
        )
    )
    counts = seen.groupBy("label").agg(F.sum("t").alias("support"), F.sum("p").alias("p"), F.sum("h").alias("h"))
    rows = counts.select(
        "label", _guarded(F.col("h"), F.col("p")).alias("precision"), _guarded(F.col("h"), F.col("support")).alias("recall"),
        _guarded(2 * F.col("h"), F.col("p") + F.col("support")).alias("f1"), "support",
    )
    measures = ("precision", "recall", "f1")
    macro = rows.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = rows.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures], F.sum("support").alias("support")
    )
    return (
        rows.unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
    )


def auc_one_vs_rest(df: DataFrame, truth: str, scores: Sequence[str]) -> DataFrame:
    """AUC of each class against the others and its share; class k is scored by ``scores[k]``."""
    cells = F.array(*[F.struct(F.lit(k).alias("class"), F.col(s).cast("double").alias("s")) for k, s in enumerate(scores)])
    long = df.select(F.col(truth).alias("_truth"), F.inline(cells))
    table = R.score_table(long, "s", F.col("_truth") == F.col("class"), keys=("class",))
    area = R.concordance(table, ("class",)).select("class", ((F.col("concordant") + F.col("tied") / 2) / F.col("pairs")).alias("auc"))
    n = df.groupBy(F.col(truth).alias("class")).agg(F.count(F.lit(1)).alias("support"))
    return attach(area, n, ["class"])


def auc_one_vs_one(df: DataFrame, truth: str, scores: Sequence[str]) -> DataFrame:
    """AUC(i | j): class i against class j by the score of i. A row enters the 2 (k - 1) pairs of its class."""
    k = len(scores)
    columns = F.array(*[F.col(s).cast("double") for s in scores])
    base = df.select(F.col(truth).cast("int").alias("_t"), columns.alias("_s"))
    other = base.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).filter("_o <> _t")
    sides = F.array(
        F.struct(F.col("_t").alias("i"), F.col("_o").alias("j"), F.get("_s", F.col("_t")).alias("s"), F.lit(True).alias("y")),
        F.struct(F.col("_o").alias("i"), F.col("_t").alias("j"), F.get("_s", F.col("_o")).alias("s"), F.lit(False).alias("y")),
    )
    long = other.select(F.inline(sides))
    table = R.score_table(long, "s", F.col("y"), keys=("i", "j"))
    return R.concordance(table, ("i", "j")).select(
        "i", "j", ((F.col("concordant") + F.col("tied") / 2) / F.col("pairs")).alias("auc")
    )


def balanced_log_loss(df: DataFrame, label: Column, probability: Column, eps: float = 2.220446049250313e-16) -> DataFrame:
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), probability))
    zero, one = F.avg(F.when(~label, -F.log(1 - p))), F.avg(F.when(label, -F.log(p)))
    return df.agg(((zero + one) / 2).alias("log_loss"))


def calibration(df: DataFrame, label: Column, probability: Column, bins: int) -> DataFrame:
    """Mean prediction and observed share per equal-width probability bin."""
    place = F.least(F.floor(probability * bins), F.lit(bins - 1)).alias("bin")
    return df.groupBy(place).agg(
        F.avg(probability).alias("predicted"), F.avg(label.cast("double")).alias("observed"), F.count(F.lit(1)).alias("n")
    )


def cost_curve(df: DataFrame, score: Column, label: Column, amount: Column, false_positive_cost: float, steps: int = 100) -> DataFrame:
    """Cost of every threshold i / steps: flagged negatives at a fixed cost plus missed positive amounts.

    A score belongs to the largest threshold not above it, so rows fold to one row per threshold
    and the curve is a running sum over those.
    """
    cell = F.greatest(F.lit(-1), F.least(F.lit(steps), F.floor(score * steps + 1e-9))).cast("int")
    folded = df.groupBy(cell.alias("i")).agg(
        F.count_if(~label).alias("neg"), F.sum(F.when(label, amount).otherwise(0.0)).alias("amount")
    )
    grid = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("i"))
    full = grid.join(folded, "i", "left").na.fill(0)
    up = Window.partitionBy(F.lit(0)).orderBy("i")
    below = F.coalesce(F.sum("amount").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    flagged = F.sum("neg").over(up.rowsBetween(0, Window.unboundedFollowing))
    curve = full.select("i", (F.col("i") / steps).alias("threshold"), (flagged * false_positive_cost + below).alias("cost"))
    return curve.filter("i >= 0").drop("i")


def error_histogram(df: DataFrame, value: Column, truth: Column, predicted: Column, width: float) -> DataFrame:
    """Histogram of a feature among missed positives and false alarms."""
    kind = F.when(truth & ~predicted, "false_negative").when(~truth & predicted, "false_positive")
    wrong = df.select(kind.alias("kind"), (F.floor(value / width) * width).alias("low")).filter("kind is not null")
    return wrong.groupBy("kind", "low").agg(F.count(F.lit(1)).alias("n"))


def regression_errors(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    d = actual - predicted
    return df.agg(
        F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"),
        F.avg(F.abs(d / actual)).alias("mape"), F.avg(2 * F.abs(d) / (F.abs(actual) + F.abs(predicted))).alias("smape"),
    )


def pinball(df: DataFrame, actual: Column, predictions: Mapping[float, Column]) -> DataFrame:
    d = {a: actual - p for a, p in predictions.items()}
    row = df.agg(*[F.avg(F.greatest(a * x, (a - 1) * x)).alias(f"l{i}") for i, (a, x) in enumerate(d.items())])
    return row.select(F.inline(F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.col(f"l{i}").alias("loss")) for i, a in enumerate(d)])))


def interval_quality(df: DataFrame, actual: Column, low: Column, high: Column) -> DataFrame:
    inside = ((actual >= low) & (actual <= high)).cast("double")
    return df.agg(F.avg(inside).alias("coverage"), F.avg(high - low).alias("mean_width"))


SCORES = ("absolute", "gamma", "normalised", "lower", "upper")


def conformal_scores(actual: Column, centre: Column, scale: Column, low: Column, high: Column) -> dict[str, Column]:
    """The conformity scores: absolute, relative, scaled residuals, and both one-sided ones."""
    gap = F.abs(actual - centre)
    return {"absolute": gap, "gamma": gap / centre, "normalised": gap / scale, "lower": low - actual, "upper": actual - high}


def conformal_quantiles(df: DataFrame, scores: Mapping[str, Column], alpha: float) -> DataFrame:
    """The ceil((1 - alpha)(n + 1))-th smallest of each score; infinite when there are too few rows."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), c.cast("double").alias("value")) for n, c in scores.items()]))
    )
    ranks = value_ranks(long, ["column"])
    sizes = ranks.groupBy("column").agg(F.sum("n").alias("size"))
    placed = attach(ranks, sizes, ["column"])
    k = F.ceil((F.col("size") + 1) * F.lit(1 - alpha))
    hit = F.when((F.col("upto") - F.col("n") < k) & (k <= F.col("upto")), F.col("value"))
    return placed.groupBy("column").agg(F.coalesce(F.max(hit), F.lit(float("inf"))).alias("quantile"), F.max("size").alias("size"))


def split_shares(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Share of each class in the whole and in every part, and the part's error in per cent."""
    tagged = None
    for name, part in parts.items():
        one = part.select(F.col(label).alias("label"), F.lit(name).alias("part"))
        tagged = one if tagged is None else tagged.union(one)
    counts = tagged.groupBy("label").agg(*[F.count_if(F.col("part") == p).alias(p) for p in parts])
    totals = counts.agg(*[F.sum(p).alias(p) for p in parts]).first()
    whole = [F.col(p) for p in parts]
    overall = sum(whole[1:], whole[0]) / sum(totals[p] for p in parts)
    out = counts.select("label", overall.alias("overall"), *[(F.col(p) / totals[p]).alias(p) for p in parts])
    return out.withColumns({f"{p}_error": (F.col(p) / F.col("overall") - 1) * 100 for p in parts})


def dffits_flags(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Rows whose internal DFFITS of a one-feature regression passes 2 sqrt(p / n), per feature and any.

    One aggregate gives the sums of all regressions; the rest is arithmetic per row.
    """
    y = F.col(target)
    sums = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.var_pop(y).alias("vy")]
    for f in features:
        sums += [F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}"), F.covar_pop(f, target).alias(f"c_{f}")]
    s = df.agg(*sums).first()
    n = s["n"]
    limit = 2 * (2 / n) ** 0.5
    out, flags = df, []
    for f in features:
        slope = s[f"c_{f}"] / s[f"v_{f}"]
        residual_variance = n * (s["vy"] - slope * s[f"c_{f}"]) / (n - 2)
        x = F.col(f) - s[f"m_{f}"]
        residual = y - s["my"] - slope * x
        leverage = 1 / n + x * x / (n * s[f"v_{f}"])
        internal = residual / F.sqrt(F.lit(residual_variance) * (1 - leverage))
        flag = F.abs(internal * F.sqrt(leverage / (1 - leverage))) > limit
        flags.append(f"{f}_flag")
        out = out.withColumn(f"{f}_flag", flag.cast("int"))
    return out.withColumn("any_flag", F.greatest(*flags) if len(flags) > 1 else F.col(flags[0]))


def kde_on_grid(df: DataFrame, value: Column, points: int) -> DataFrame:
    """Gaussian kernel density on a grid, exact.

    Equal values are folded first; the kernel sums are folded in every task, so one row per grid point and task is
    exchanged. Of a constant column the density has no width and no row comes out.
    """
    v = value.cast("double")
    s = df.agg(F.count(v).alias("n"), F.stddev_samp(v).alias("sd"), F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    width = (s["sd"] or 0.0) * s["n"] ** -0.2 if s["n"] else 0.0
    if not width:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    cells = df.filter(v.isNotNull()).groupBy(v.alias("c")).agg(F.count(F.lit(1)).alias("m"))
    step = (s["hi"] - s["lo"]) / (points - 1)
    at = cells.select("c", "m", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    at = at.withColumn("x", s["lo"] + F.col("i") * step)
    z = (F.col("x") - F.col("c")) / width
    return at.groupBy("i").agg(
        F.max("x").alias("x"), (F.sum(F.col("m") * F.exp(-z * z / 2)) / (s["n"] * width * (2 * 3.141592653589793) ** 0.5)).alias("density")
    )


def knee(curve: DataFrame, x: str, y: str) -> DataFrame:
    """Elbow of a falling convex curve: the point farthest below the chord of the unit-scaled curve; an empty curve has none."""
    e = curve.agg(*[f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if e[f"lo_{x}"] is None:
        return curve.select(x, y, F.lit(0.0).alias("gap")).limit(0)
    sx = (F.col(x) - e[f"lo_{x}"]) / ((e[f"hi_{x}"] - e[f"lo_{x}"]) or 1.0)
    sy = (F.col(y) - e[f"lo_{y}"]) / ((e[f"hi_{y}"] - e[f"lo_{y}"]) or 1.0)
    gap = (1 - sx) - sy
    scored = curve.withColumn("gap", gap)
    return scored.agg(F.max_by(F.struct(x, y, "gap"), F.struct(F.col("gap"), -F.col(x))).alias("b")).select("b.*")
