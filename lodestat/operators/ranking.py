"""The ranking core: one row per distinct score with class counts and running totals.

ROC, precision-recall, Somers' D, gains and cost curves are all sums over this table, so the rows
of the input are touched once, by a grouped count that folds equal scores before the exchange.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import running_totals


def score_table(
    df: DataFrame, score: str, label: Column, weight: Column | None = None, extra: dict[str, Column] | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """(keys, score, pos, neg, rows...) with ``cum_*`` totals over scores from the top down.

    ``label`` is a boolean column, ``weight`` a non-negative column (1 by default).
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    sums = {
        "pos": F.sum(F.when(label, w).otherwise(0.0)),
        "neg": F.sum(F.when(label, 0.0).otherwise(w)),
        **{name: F.sum(c) for name, c in (extra or {}).items()},
    }
    table = df.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(*[c.alias(n) for n, c in sums.items()])
    return running_totals(table, "score", list(sums), keys, descending=True)


def totals(df: DataFrame, label: Column, weight: Column | None = None) -> Column:
    """Struct (pos, neg) of the whole table as a scalar."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    return df.agg(
        F.struct(
            F.sum(F.when(label, w).otherwise(0.0)).alias("pos"), F.sum(F.when(label, 0.0).otherwise(w)).alias("neg")
        ).alias("t")
    ).scalar()


def concordance(table: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per key the weight of concordant, tied and all (positive, negative) pairs."""
    above = F.col("cum_pos") - F.col("pos")
    return table.groupBy(*keys).agg(
        F.sum(F.col("neg") * above).alias("concordant"),
        F.sum(F.col("neg") * F.col("pos")).alias("tied"),
        (F.sum("pos") * F.sum("neg")).alias("pairs"),
    )


def somers_d(df: DataFrame, score: str, label: Column, weight: Column | None = None) -> DataFrame:
    """(concordant - discordant) / pairs; 0 when a class has no weight. One row, column ``somers_d``."""
    c = concordance(score_table(df, score, label, weight))
    discordant = F.col("pairs") - F.col("concordant") - F.col("tied")
    value = F.when(F.col("pairs") > 0, (F.col("concordant") - discordant) / F.col("pairs")).otherwise(0.0)
    return c.select(value.alias("somers_d"))


def auc(df: DataFrame, score: str, label: Column, weight: Column | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve, ties count one half."""
    c = concordance(score_table(df, score, label, weight, keys=keys), keys)
    return c.select(*keys, ((F.col("concordant") + F.col("tied") / 2) / F.col("pairs")).alias("auc"))


def average_precision(table: DataFrame, pos: Column) -> DataFrame:
    """Sum of precision times the step of recall, from the top score down."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return table.agg(F.sum(precision * F.col("pos") / pos).alias("average_precision"))


def roc_pr_points(df: DataFrame, score: str, label: Column) -> DataFrame:
    t = totals(df, label)
    table = score_table(df, score, label)
    return table.select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / t["pos"]).alias("tpr"),
        (F.col("cum_neg") / t["neg"]).alias("fpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
    )


def gains(df: DataFrame, score: str, label: Column, negative_weight: float = 20.0) -> DataFrame:
    """Cumulative share of weight and of positives by falling score (Lorenz curve)."""
    w = F.when(label, 1.0).otherwise(negative_weight)
    t = totals(df, label, w)
    table = score_table(df, score, label, w)
    return table.select(
        "score",
        "pos",
        "neg",
        ((F.col("cum_pos") + F.col("cum_neg")) / (t["pos"] + t["neg"])).alias("weight_share"),
        (F.col("cum_pos") / t["pos"]).alias("captured"),
    )


def amex_metric(df: DataFrame, score: str, label: Column, negative_weight: float = 20.0, top: float = 0.04) -> DataFrame:
    """Mean of the normalised weighted Gini and the share of positives in the top part by weight.

    Rows of one score are taken together: a distinct score is inside the top part when its whole
    weight is.
    """
    table = gains(df, score, label, negative_weight)
    t = totals(df, label, F.when(label, 1.0).otherwise(negative_weight))
    step = (F.col("pos") + F.col("neg")) / (t["pos"] + t["neg"])
    gini = F.sum((F.col("captured") - F.col("weight_share")) * step)
    row = table.agg(
        gini.alias("gini"),
        F.coalesce(F.max(F.when(F.col("weight_share") <= top, F.col("captured"))), F.lit(0.0)).alias("top_share"),
    )
    best = (1 - t["pos"] / (t["pos"] + t["neg"])) / 2
    return row.select(
        (F.col("gini") / best).alias("gini"),
        "top_share",
        ((F.col("gini") / best + F.col("top_share")) / 2).alias("metric"),
    )


METRICS = {
    "somers_d": lambda df, score, label: somers_d(df, score, label),
    "auc": lambda df, score, label: auc(df, score, label),
    "amex": lambda df, score, label: amex_metric(df, score, label).select("metric"),
}


class RankingEvaluator(Evaluator):
    """A ranking measure as an evaluator, for cross-validation of pipelines."""

    def __init__(self, score: str, label: str, metric: str = "somers_d"):
        super().__init__()
        self.score, self.label, self.metric = score, label, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(METRICS[self.metric](dataset, self.score, F.col(self.label).cast("boolean")).first()[0])

    def isLargerBetter(self) -> bool:
        return True
